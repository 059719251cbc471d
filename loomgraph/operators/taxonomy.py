"""Taxonomy, hierarchy and the links they give rise to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.model import Graph
from loomgraph.operators.algorithms import shared


def mapped(g: Graph, name: str) -> DataFrame:
    """topic, value: what the topic's concepts carry of another field (MAPPED_TO_<FIELD>), each pair once."""
    topics = g.of_field(g.topic_field).withColumnRenamed("value", "topic")
    return topics.join(g.of_field(name), "concept").select("topic", "value").distinct()


def _linked(g: Graph, chains: DataFrame) -> DataFrame:
    topics = g.of_field(g.topic_field)
    source = topics.select(F.col("concept").alias("source"), F.col("value").alias("a"))
    target = topics.select(F.col("concept").alias("target"), F.col("value").alias("b"))
    # counting edges per pair of concepts first keeps the rows that the joins multiply few
    pairs = chains.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))
    rows = pairs.join(source, "source").join(target, "target").where("a <> b")
    return rows.groupBy(F.col("a").alias("source"), F.col("b").alias("target")).agg(F.sum("n").alias("strength"))


def linked_topics(g: Graph) -> DataFrame:
    """source, target, strength (IS_LINKED_TO) over stored edges, one per (source, target, type)."""
    return _linked(g, g.chains.select("source", "target", "type").distinct())


def linked_topics_raw(g: Graph) -> DataFrame:
    """The same over chains as annotated, repeats included."""
    return _linked(g, g.chains)


def hierarchy(g: Graph) -> DataFrame:
    return g.hierarchy.distinct().orderBy("type", "child", "parent")


def closure(edges: DataFrame) -> DataFrame:
    """node, ancestor, depth (the least), each node its own at depth 0; cycles end because reached pairs are dropped.

    Pairs reached at one depth are joined with the edges until none is new.
    """
    up = edges.select(F.col("child"), F.col("parent")).distinct()
    nodes = up.select(F.col("child").alias("node")).unionByName(up.select(F.col("parent").alias("node"))).distinct()
    reached = shared(nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth")))
    front, depth = reached, 0
    while True:
        depth += 1
        step = front.join(up, front.ancestor == up.child).select("node", F.col("parent").alias("ancestor")).distinct()
        front = shared(step.join(reached, ["node", "ancestor"], "left_anti").withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            break
        reached = shared(reached.unionByName(front))
    return reached


def subtree_evidence(edges: DataFrame, located: DataFrame) -> DataFrame:
    """ancestor, items: distinct items that mention it or anything below.  located: concept, item_id."""
    below = closure(edges).select(F.col("node").alias("concept"), "ancestor")
    return located.join(below, "concept").groupBy("ancestor").agg(F.countDistinct("item_id").alias("items"))
