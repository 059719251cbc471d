"""Connected components of a distributed edge list by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import checkpointed, discard, written

MAX_ROUNDS = 60


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node and smallest node of its component, for every node of a local edge list that is not that smallest one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            break
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """From edges (u, v) to (u, root) for every node but the roots themselves; root is the component's smallest node.

    Minima are partial aggregates, so a hub costs each task one row.  They are written before they are joined: Spark then
    deals both sides of the join itself and can split a hub's edges over tasks.  Rounds grow with the logarithm of the
    longest path.
    """
    edges = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, first = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large, second = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low, third = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        for path in (first, second, third):
            discard(edges.sparkSession, path)
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select("u", F.col("v").alias("root"))
