"""The analytics behind the drawn graph: what is shown, how it is grouped, and the evidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.functions import text
from loomgraph.model import Graph


@dataclass(frozen=True)
class Scope:
    """What is shown; the defaults show everything."""

    min_frequency: int = 0
    min_source_count: int = 0
    max_nodes: int = 0
    include_isolated: bool = True
    max_hyperedges: int = 50
    group_by: str | None = None


def endpoint_degree(chains: DataFrame) -> DataFrame:
    """name, degree: occurrences as an end of a chain; a loop counts twice."""
    ends = chains.select(F.explode(F.array("source", "target")).alias("name"))
    return ends.groupBy("name").agg(F.count(F.lit(1)).alias("degree"))


def coverage(g: Graph) -> DataFrame:
    """name, frequency (mention rows), sources (distinct) of mentioned concepts."""
    rows = g.mentions.select("concept", "item_id").join(g.from_source.dropDuplicates(["item_id"]), "item_id", "left")
    return rows.groupBy(F.col("concept").alias("name")).agg(F.count(F.lit(1)).alias("frequency"), F.countDistinct("ref").alias("sources"))


def kept(g: Graph, s: Scope) -> DataFrame:
    """name of the ontology's concepts that pass; the most connected ones if there are too many, ties by name."""
    names = g.concepts.select("name").distinct()
    if s.min_frequency > 0 or s.min_source_count > 0:
        names = names.join(coverage(g), "name", "left").na.fill(0, ["frequency", "sources"])
        names = names.where((F.col("frequency") >= s.min_frequency) & (F.col("sources") >= s.min_source_count)).select("name")
    if not s.include_isolated:
        names = names.join(endpoint_degree(g.chains), "name", "left_semi")
    if s.max_nodes > 0:
        degree = endpoint_degree(g.chains)
        names = names.join(degree, "name", "left").na.fill(0, ["degree"]).orderBy(F.desc("degree"), "name").limit(s.max_nodes).select("name")
    return names


def kept_chains(g: Graph, names: DataFrame) -> DataFrame:
    a, b = names.select(F.col("name").alias("source")), names.select(F.col("name").alias("target"))
    return g.chains.join(a, "source", "left_semi").join(b, "target", "left_semi")


def grouping_field(g: Graph, group_by: str | None = None) -> str | None:
    """The field asked for, else the first that begins with topic, else the first."""
    if group_by in g.graph_fields:
        return group_by
    return next((f for f in g.graph_fields if f.lower().startswith("topic")), g.graph_fields[0] if g.graph_fields else None)


def groups(g: Graph, names: DataFrame, group_by: str | None = None) -> DataFrame:
    """name, group: the first value of the field, Other without one; All where there is no field."""
    field = grouping_field(g, group_by)
    if field is None:
        return names.select("name", F.lit("All").alias("group"))
    first = g.values.where(F.col("field") == field).groupBy(F.col("concept").alias("name")).agg(F.min_by("value", F.struct("ord", "value")).alias("value"))
    return names.join(first, "name", "left").select("name", F.when(F.coalesce("value", F.lit("")) == "", "Other").otherwise(F.col("value")).alias("group"))


def legend(grouped: DataFrame) -> DataFrame:
    """cid, group, count: the largest group is 0, equal ones by name.  The window sees groups only."""
    counts = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("count"))
    return counts.select((F.row_number().over(W.orderBy(F.desc("count"), "group")) - 1).alias("cid"), "group", "count")


def slugs(names: DataFrame) -> DataFrame:
    """name, slug: equal slugs get _2, _3, ... in order of name."""
    base = names.select("name").distinct().withColumn("base", text.slug(F.col("name")))
    place = F.row_number().over(W.partitionBy("base").orderBy("name"))
    return base.select("name", F.when(place == 1, F.col("base")).otherwise(F.concat_ws("_", "base", place)).alias("slug"))


def edges(g: Graph) -> DataFrame:
    """source, target, total, dominant type, relations ("TYPE xN", most first, then first seen), sources, width; all chains.

    Types are counted per pair first, and (pair, reference) once each, so a pair's row holds its types and nothing else.
    """
    located = g.chains.join(g.from_source, "item_id", "left").select("source", "target", "type", "ord", F.coalesce("ref", "item_id").alias("ref"))
    once = located.groupBy("source", "target", "ref", "type").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord"))
    refs = once.groupBy("source", "target", "ref").agg(F.lit(1).alias("one")).groupBy("source", "target").agg(F.count(F.lit(1)).alias("sources"))
    typed = once.groupBy("source", "target", "type").agg(F.sum("n").alias("n"), F.min("ord").alias("ord"))
    pair = typed.groupBy("source", "target").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "ord", "type"))).alias("types"))
    shown = F.array_join(F.transform("types", lambda x: F.concat(x["type"], F.lit(" x"), (-x["less"]).cast("string"))), " | ")
    pair = pair.join(refs, ["source", "target"])
    return pair.select("source", "target", "total", F.col("types")[0]["type"].alias("dominant"), shown.alias("relations"), "sources", edge_width(F.col("total")).alias("width"))


def grouped(g: Graph) -> DataFrame:
    """source, target, relation ("many" for several types), types in the order they were first seen."""
    typed = g.chains.groupBy("source", "target", "type").agg(F.min("ord").alias("ord"))
    pairs = typed.groupBy("source", "target").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "type"))), lambda x: x["type"]).alias("types"))
    return pairs.select("source", "target", F.when(F.size("types") > 1, "many").otherwise(F.col("types")[0]).alias("relation"), F.array_join("types", ", ").alias("types"))


def edge_width(total: Column) -> Column:
    return F.round(1 + F.least(total, F.lit(40)) * 0.35, 2)


def node_size(degree: Column, filtered: Column) -> Column:
    return F.when(filtered, F.lit(8.0)).otherwise(8.0 + F.least(degree, F.lit(30)))


def hyperedges(g: Graph, names: DataFrame, limit: int = 50) -> DataFrame:
    """block, size, label, source of annotated blocks that link three kept concepts or more; largest first, ties by block."""
    rows = g.chains.join(g.items.select("item_id", F.col("annotation_id").alias("annotation")), "item_id", "left")
    rows = rows.withColumn("block", F.coalesce("annotation", text.block_of(F.col("item_id"))))
    ends = rows.select("block", F.explode(F.array("source", "target")).alias("name")).distinct().join(names, "name", "left_semi")
    sized = ends.groupBy("block").agg(F.count(F.lit(1)).alias("size")).where("size >= 3").orderBy(F.desc("size"), "block").limit(max(0, limit))
    first = rows.groupBy("block").agg(F.min_by("item_id", F.struct("ord", "item_id")).alias("item_id"))
    told = sized.join(first, "block").join(g.items.select("item_id", "description"), "item_id", "left").join(g.from_source, "item_id", "left")
    source = F.coalesce("ref", "block")
    label = F.when(F.coalesce("description", F.lit("")) == "", F.concat(source, F.lit(" - "), F.col("block"))).otherwise(text.shortened(F.col("description")))
    return told.select("block", "size", label.alias("label"), source.alias("source"))


EVIDENCE_EACH = 60


def evidence(g: Graph, each: int = EVIDENCE_EACH) -> DataFrame:
    """concept, source, type, text, anchor, analysis, note: one row per item and relation type, the first ``each`` of a concept.

    The row numbers are limited before the shuffle, so a concept with many mentions costs each task ``each`` rows.
    """
    ends = g.chains.select("item_id", F.explode(F.array("source", "target")).alias("concept"), "type").distinct()
    said = g.mentions.select("concept", "item_id").distinct().join(ends, ["concept", "item_id"], "left").withColumn("type", F.coalesce("type", F.lit("")))
    rows = said.join(g.items.select("item_id", F.trim(F.coalesce("citation", F.lit(""))).alias("text"), F.trim(F.coalesce("description", F.lit(""))).alias("raw")), "item_id")
    rows = rows.where("text <> '' or raw <> ''")
    place = F.row_number().over(W.partitionBy("concept").orderBy("item_id", "type"))
    rows = rows.withColumn("place", place).where(F.col("place") <= each).join(g.from_source, "item_id", "left")
    anchor, analysis = text.note_field(F.col("raw"), "anchor"), text.note_field(F.col("raw"), "analysis")
    return rows.select(
        "concept", "item_id", "place", F.substring(F.coalesce("ref", "item_id"), 1, 60).alias("source"), "type", F.substring("text", 1, 300).alias("text"),
        F.substring(anchor, 1, 200).alias("anchor"), F.substring(analysis, 1, 300).alias("analysis"),
        F.when((anchor == "") & (analysis == ""), F.substring("raw", 1, 300)).otherwise("").alias("note"),
    )


def first_sources(g: Graph) -> DataFrame:
    """concept, source: of the first item that mentions it and has one."""
    rows = g.located if g.located is not None else g.mentions.join(g.from_source, "item_id")
    return rows.where("ref is not null").groupBy("concept").agg(F.min_by("ref", F.struct("item_id", "ref")).alias("source"))


def nodes(g: Graph, s: Scope) -> DataFrame:
    """name, slug, group, cid, degree, size, filtered: kept concepts, and ends of chains beyond them as filtered."""
    names = kept(g, s)
    grouped = groups(g, names, s.group_by).join(legend(groups(g, names, s.group_by)), "group")
    ends = g.chains.select(F.explode(F.array("source", "target")).alias("name")).where("name <> ''").distinct()
    beyond = ends.join(names, "name", "left_anti").select("name", F.lit("Other").alias("group"), F.lit(0).alias("cid"), F.lit(True).alias("filtered"))
    every = grouped.select("name", "group", "cid", F.lit(False).alias("filtered")).unionByName(beyond)
    every = every.join(endpoint_degree(kept_chains(g, names)), "name", "left").na.fill(0, ["degree"]).join(slugs(every), "name")
    return every.select("name", "slug", "group", "cid", "degree", node_size(F.col("degree"), F.col("filtered")).alias("size"), "filtered")


def find(names: DataFrame, part: str, limit: int = 20) -> DataFrame:
    """Names that contain a part, in any case, the first in order."""
    return names.where(F.contains(F.lower("name"), F.lit(part.lower()))).select("name").orderBy("name").limit(limit)


def visible(names: DataFrame, neighbor_counts: DataFrame, least: int, hidden: list[int]) -> DataFrame:
    """Nodes with enough neighbours in communities that are not hidden; filtered ones always."""
    rows = names.join(neighbor_counts, "name", "left").na.fill(0, ["neighbor_count"])
    shown = (F.col("neighbor_count") >= least) & ~F.col("cid").isin(hidden) if hidden else F.col("neighbor_count") >= least
    return rows.where(F.col("filtered") | shown)
