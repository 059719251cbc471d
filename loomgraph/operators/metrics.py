"""Native metrics.  Each side of a count is aggregated before it is joined, so no row fans out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.model import Graph
from loomgraph.operators.taxonomy import linked_topics


def degrees(g: Graph) -> DataFrame:
    """name, out_degree, in_degree, degree: distinct neighbours each way; none is 0; a neighbour both ways counts twice.

    A pair gives a row to each of its ends, an ontology concept one of zeros, so one grouping finds all vertices too.
    """
    end = lambda name, out, into: F.struct(F.col(name).alias("name"), F.lit(out).alias("out"), F.lit(into).alias("into"))
    ends = g.chains.select("source", "target").distinct().select(F.explode(F.array(end("source", 1, 0), end("target", 0, 1))).alias("x")).select("x.*")
    rows = ends.unionByName(g.concepts.select("name", F.lit(0).alias("out"), F.lit(0).alias("into"))).where("name is not null and name <> ''")
    both = rows.groupBy("name").agg(F.sum("out").alias("out_degree"), F.sum("into").alias("in_degree"))
    return both.withColumn("degree", F.col("out_degree") + F.col("in_degree"))


def located_mentions(g: Graph) -> DataFrame:
    """concept, item_id, ref of mentions whose item has a source; one row each, however often it is mentioned."""
    if g.located is not None:
        return g.located.select("concept", "item_id", "ref").distinct()
    return g.mentions.select("concept", "item_id").distinct().join(g.from_source, "item_id", "left")


def mention_counts(g: Graph) -> DataFrame:
    """name, mention_count (items), source_count (sources); 0 for concepts that nothing mentions.

    An item has one source, so items are counted within (concept, source) first, and concepts add up what is left of that.
    """
    per = located_mentions(g).groupBy("concept", "ref").agg(F.count(F.lit(1)).alias("n"))
    counts = per.groupBy(F.col("concept").alias("name")).agg(F.sum("n").alias("mention_count"), F.count("ref").alias("source_count"))
    return g.vertices().join(counts, "name", "left").na.fill(0, ["mention_count", "source_count"])


def taxonomy_counts(g: Graph) -> DataFrame:
    """field, value, concept_count of values that have concepts."""
    return g.values.select("field", "value", "concept").distinct().groupBy("field", "value").agg(F.count(F.lit(1)).alias("concept_count"))


def topic_weights(g: Graph) -> DataFrame:
    """topic, weighted_degree: strengths of links on either side, 0 without any."""
    links = linked_topics(g)
    each = links.select(F.col("source").alias("topic"), "strength").unionByName(links.select(F.col("target").alias("topic"), "strength"))
    weight = each.groupBy("topic").agg(F.sum("strength").alias("weighted_degree"))
    topics = g.of_field(g.topic_field).select(F.col("value").alias("topic")).distinct()
    return topics.join(weight, "topic", "left").na.fill(0, ["weighted_degree"])


def diversity(g: Graph, name: str) -> DataFrame:
    """topic, <name>_diversity: distinct values of the field over the topic's concepts."""
    topics = g.of_field(g.topic_field).withColumnRenamed("value", "topic")
    other = g.of_field(name).withColumnRenamed("value", "other")
    return topics.join(other, "concept", "left").groupBy("topic").agg(F.countDistinct("other").alias(f"{name}_diversity"))


def source_metrics(g: Graph) -> DataFrame:
    """bibtex, item_count, concept_count; 0 for sources without items."""
    items = g.from_source.distinct().groupBy(F.col("ref").alias("bibtex")).agg(F.count(F.lit(1)).alias("item_count"))
    if g.located is not None:
        pairs = g.located.select("ref", "concept").distinct()
    else:
        pairs = g.from_source.join(g.mentions, "item_id").select("ref", "concept").distinct()
    concepts = pairs.groupBy(F.col("ref").alias("bibtex")).agg(F.count("concept").alias("concept_count"))
    return g.sources.select("bibtex").join(items, "bibtex", "left").join(concepts, "bibtex", "left").na.fill(0, ["item_count", "concept_count"])


def counting_units(g: Graph) -> DataFrame:
    """One row: sources, annotations, items, mentions, concepts, relations as they are stored."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    parts = [
        count(g.sources, "sources"),
        g.items.agg(F.countDistinct("annotation_id").alias("annotations")),
        count(g.items, "items"),
        count(g.mentions, "mentions"),
        count(g.vertices(), "concepts"),
        count(g.chains.select("source", "target", "type").distinct(), "relations"),
    ]
    out = parts[0]
    for p in parts[1:]:  # rows of one, so this product is one row
        out = out.join(p, F.lit(True))
    return out
