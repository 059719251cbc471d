"""The published questions of an analyst, over a graph and its metric tables.

m: name, pagerank, betweenness, community, degree, mention_count, source_count of concepts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.model import Graph, relation_of
from loomgraph.operators import metrics


def label_counts(g: Graph) -> DataFrame:
    parts = [("Source", g.sources), ("Item", g.items), (g.concept_label, g.vertices())]
    parts += [(f.capitalize(), g.of_field(f).select("value").distinct()) for f in g.graph_fields]
    out = None
    for label, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(label).alias("label"), "count")
        out = one if out is None else out.unionByName(one)
    return out


def schema(g: Graph) -> DataFrame:
    rows = [("Item", "FROM_SOURCE", "Source", g.from_source), ("Item", "MENTIONS", g.concept_label, g.mentions), (g.concept_label, "RELATES_TO", g.concept_label, g.chains)]
    out = None
    for a, rel, b, df in rows:
        one = df.limit(1).select(F.lit(a).alias("source"), F.lit(rel).alias("relation"), F.lit(b).alias("target"))
        out = one if out is None else out.unionByName(one)
    for f in g.graph_fields:
        out = out.unionByName(g.of_field(f).limit(1).select(F.lit(g.concept_label).alias("source"), F.lit(relation_of(f)).alias("relation"), F.lit(f.capitalize()).alias("target")))
    return out


def top_pagerank(m: DataFrame, k: int = 10) -> DataFrame:
    rows = m.where("pagerank is not null").select(F.col("name").alias("concept"), F.round("pagerank", 4).alias("pagerank"), F.col("mention_count").alias("mentions"), F.col("source_count").alias("sources"))
    return rows.orderBy(F.desc("pagerank"), "concept").limit(k)


def bridges(m: DataFrame, k: int = 10) -> DataFrame:
    rows = m.where("betweenness > 0").select(F.col("name").alias("concept"), F.round("betweenness", 2).alias("betweenness"), "community", "pagerank")
    return rows.orderBy(F.desc("betweenness"), "concept").limit(k)


def communities(m: DataFrame, examples: int = 5) -> DataFrame:
    """community, total, examples: the first names.  A name's place is found by hash-limited rank, not by gathering all."""
    from pyspark.sql import Window as W

    known = m.where("community is not null").select("community", "name")
    first = known.withColumn("place", F.row_number().over(W.partitionBy("community").orderBy("name"))).where(F.col("place") <= examples)
    total = known.groupBy("community").agg(F.count(F.lit(1)).alias("total"))
    shown = first.groupBy("community").agg(F.sort_array(F.collect_list("name")).alias("names")).select("community", F.array_join("names", ",").alias("examples"))
    return total.join(shown, "community")


def compare_communities(m: DataFrame) -> DataFrame:
    rows = m.where("community is not null").groupBy("community").agg(F.count(F.lit(1)).alias("concepts"), F.avg("pagerank").alias("p"), F.avg("mention_count").alias("n"))
    return rows.select("community", "concepts", F.round("p", 4).alias("average_pagerank"), F.round("n", 1).alias("average_mentions"))


def evidence_of(g: Graph, concept: str) -> DataFrame:
    """Mentions of one concept with item and source: the filter reaches the scan, so the joins see its items only."""
    said = g.mentions.where(F.col("concept") == concept).select("concept", "item_id")
    return said.join(g.items.drop("ref"), "item_id").join(g.from_source, "item_id").join(g.sources.withColumnRenamed("bibtex", "ref"), "ref")


def citations(g: Graph, concept: str) -> DataFrame:
    return evidence_of(g, concept).select(F.col("title").alias("source"), "citation", F.col("source_file").alias("file"), F.col("source_line").alias("line"))


def sources_of(g: Graph, concept: str) -> DataFrame:
    return evidence_of(g, concept).groupBy(F.col("title").alias("source"), F.col("ref").alias("id")).agg(F.count(F.lit(1)).alias("citations"))


def trace(g: Graph, concept: str, k: int = 20) -> DataFrame:
    rows = evidence_of(g, concept).select("concept", "citation", F.col("source_file").alias("file"), F.col("source_line").alias("line"), F.col("title").alias("source"))
    return rows.orderBy("source", "line", "citation").limit(k)


def paths(g: Graph) -> DataFrame:
    """concept, item_id, source over all concepts."""
    return g.mentions.select("concept", "item_id").join(g.from_source, "item_id").select("concept", "item_id", F.col("ref").alias("source"))


def direct(g: Graph, concept: str) -> DataFrame:
    rows = g.relates_to().where((F.col("source") == concept) | (F.col("target") == concept))
    out = rows.where(F.col("source") == concept).select(F.col("source").alias("origin"), "type", F.col("target").alias("target"))
    into = rows.where((F.col("target") == concept) & (F.col("source") != concept)).select(F.col("target").alias("origin"), "type", F.col("source").alias("target"))
    return out.unionByName(into).select("origin", F.lit("RELATES_TO").alias("relationship"), "type", "target")


def by_taxonomy(g: Graph, concept: str) -> DataFrame:
    topics = g.of_field(g.topic_field)
    mine = topics.where(F.col("concept") == concept).select("value")
    rest = topics.where(F.col("concept") != concept).join(mine, "value")
    return rest.groupBy(F.col("value").alias("topic")).agg(F.array_join(F.sort_array(F.collect_set("concept")), ",").alias("related_concepts"))


def topics(g: Graph) -> DataFrame:
    total = g.of_field(g.topic_field).groupBy(F.col("value").alias("topic")).agg(F.count(F.lit(1)).alias("total"))
    return total.join(metrics.topic_weights(g).withColumnRenamed("weighted_degree", "weight"), "topic").join(metrics.diversity(g, "aspect"), "topic")


def topic_members(g: Graph, examples: int = 5) -> DataFrame:
    m = g.of_field(g.topic_field).select(F.col("value").alias("community"), F.col("concept").alias("name"))
    return communities(m, examples).withColumnRenamed("community", "topic")


def topic_by_aspect(g: Graph, k: int = 20) -> DataFrame:
    a = g.of_field(g.topic_field).withColumnRenamed("value", "topic")
    b = g.of_field("aspect").withColumnRenamed("value", "aspect")
    rows = a.join(b, "concept").groupBy("topic", "aspect").agg(F.count(F.lit(1)).alias("shared_concepts"))
    return rows.orderBy(F.desc("shared_concepts"), "topic", "aspect").limit(k)


def richest(g: Graph, k: int = 10) -> DataFrame:
    rows = g.sources.select("bibtex", "title").join(metrics.source_metrics(g), "bibtex")
    return rows.select(F.col("title").alias("source"), F.col("bibtex").alias("id"), F.col("item_count").alias("citations"), F.col("concept_count").alias("concepts")).orderBy(F.desc("concepts"), "id").limit(k)


def concepts_of(g: Graph, source: str) -> DataFrame:
    items = g.from_source.where(F.col("ref") == source)
    return items.join(g.mentions, "item_id").groupBy("concept").agg(F.count(F.lit(1)).alias("mentions"))


def covering(g: Graph, topic: str) -> DataFrame:
    members = g.of_field(g.topic_field).where(F.col("value") == topic).select("concept")
    rows = g.mentions.select("concept", "item_id").join(members, "concept").join(g.from_source, "item_id")
    return rows.groupBy(F.col("ref").alias("id")).agg(F.countDistinct("concept").alias("topic_concepts"))


def widespread(m: DataFrame, over: int = 5, k: int = 20) -> DataFrame:
    rows = m.where(F.col("source_count") > over).select(F.col("name").alias("concept"), F.col("source_count").alias("sources"), F.col("mention_count").alias("mentions"))
    return rows.orderBy(F.desc("sources"), "concept").limit(k)


def exclusive(g: Graph, counts: DataFrame, k: int = 20) -> DataFrame:
    single = counts.where("source_count = 1").select(F.col("name").alias("concept"), F.col("mention_count").alias("mentions"))
    rows = single.join(paths(g).select("concept", "source").distinct(), "concept").join(g.sources.select(F.col("bibtex").alias("source"), "title"), "source")
    return rows.select("concept", F.col("title").alias("single_source"), "mentions").orderBy(F.desc("mentions"), "concept").limit(k)


def isolated(degrees: DataFrame, counts: DataFrame, below: int = 3, k: int = 20) -> DataFrame:
    rows = degrees.where(F.col("degree") < below).join(counts, "name")
    return rows.select(F.col("name").alias("concept"), F.col("degree").alias("relationships"), F.col("mention_count").alias("mentions"), F.col("source_count").alias("sources")).orderBy(F.desc("mentions"), "concept").limit(k)


def triangulated(g: Graph, least: int = 3, examples: int = 3) -> DataFrame:
    from pyspark.sql import Window as W

    titles = paths(g).join(g.sources.select(F.col("bibtex").alias("source"), "title"), "source").select("concept", "title").distinct()
    count = titles.groupBy("concept").agg(F.count(F.lit(1)).alias("num_sources")).where(F.col("num_sources") >= least)
    first = titles.withColumn("place", F.row_number().over(W.partitionBy("concept").orderBy("title"))).where(F.col("place") <= examples)
    shown = first.groupBy("concept").agg(F.array_join(F.sort_array(F.collect_list("title")), ",").alias("example_sources"))
    return count.join(shown, "concept")


def saturation(g: Graph) -> DataFrame:
    """source, title, new_concepts: distinct concepts of each source (not only those seen first there)."""
    rows = paths(g).groupBy("source").agg(F.countDistinct("concept").alias("new_concepts"))
    return rows.join(g.sources.select(F.col("bibtex").alias("source"), "title"), "source").select("source", "title", "new_concepts")


def first_appearance(g: Graph) -> DataFrame:
    """source, first_seen: concepts whose smallest source it is."""
    first = paths(g).groupBy("concept").agg(F.min("source").alias("source"))
    return first.groupBy("source").agg(F.count(F.lit(1)).alias("first_seen"))
