"""Projections of the graph for algorithms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.model import Graph


def _mirrored(pairs: DataFrame) -> DataFrame:
    """Both directions of pairs a < b: the join makes half the rows, the mirror the rest."""
    return pairs.unionByName(pairs.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight"))


def co_taxonomy(g: Graph) -> DataFrame:
    """source, target, weight: values of any field that two concepts share."""
    once = g.values.select("field", "value", "concept").distinct()
    a = once.withColumnRenamed("concept", "source")
    b = once.withColumnRenamed("concept", "target")
    pairs = a.join(b, ["field", "value"]).where("source < target").groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))
    return _mirrored(pairs)


def co_citation(g: Graph) -> DataFrame:
    """source, target, weight: sources in which different items mention the two concepts.

    A pair that only one item of a source mentions does not count, for a path may not use an edge twice.  Per source and
    concept the first and last item tell whether two different items exist: they do unless both have one and the same.
    """
    once = g.located if g.located is not None else g.mentions.select("concept", "item_id").join(g.from_source, "item_id")
    ends = once.where("ref is not null").groupBy("ref", "concept").agg(F.min("item_id").alias("low"), F.max("item_id").alias("high"))
    a = ends.select("ref", F.col("concept").alias("source"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    b = ends.select("ref", F.col("concept").alias("target"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    rows = a.join(b, "ref").where("source < target and not (a_low = a_high and b_low = b_high and a_low = b_low)")
    return _mirrored(rows.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight")))


def relates_to(g: Graph) -> DataFrame:
    """source, target, weight: parallel edges of different types counted."""
    return g.chains.select("source", "target", "type").distinct().groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))


def strategy(g: Graph) -> str:
    if not g.chains.isEmpty():
        return "RELATES_TO"
    return "CO_TAXONOMY" if g.graph_fields else "CO_CITATION"


def projected(g: Graph, how: str | None = None) -> DataFrame:
    return {"RELATES_TO": relates_to, "CO_TAXONOMY": co_taxonomy, "CO_CITATION": co_citation}[how or strategy(g)](g)


def neighbours(edges: DataFrame) -> DataFrame:
    """name, neighbor_count: distinct neighbours either way; a loop counts once."""
    way = lambda a, b: F.struct(F.col(a).alias("name"), F.col(b).alias("other"))
    both = edges.select(F.explode(F.array(way("source", "target"), way("target", "source"))).alias("x")).select("x.*")
    return both.distinct().groupBy("name").agg(F.count(F.lit(1)).alias("neighbor_count"))


def within_two(edges: DataFrame, start: str) -> DataFrame:
    """related, hops: undirected paths of one or two edges from a vertex, no edge used twice."""
    numbered = edges.select("source", "target", "type").distinct()
    step = numbered.select(F.col("source").alias("a"), F.col("target").alias("b"), F.struct("source", "target", "type").alias("edge")).unionByName(
        numbered.where("source <> target").select(F.col("target").alias("a"), F.col("source").alias("b"), F.struct("source", "target", "type").alias("edge"))
    )
    one = step.where(F.col("a") == start).select(F.col("b").alias("via"), F.col("edge").alias("first"))
    two = one.join(step, F.col("via") == F.col("a")).where("edge <> first").select("via", F.col("b").alias("related"), F.lit(2).alias("hops"))
    return one.select(F.lit(None).cast("string").alias("via"), F.col("via").alias("related"), F.lit(1).alias("hops")).unionByName(two)
