"""PageRank, betweenness and communities over (source, target, weight) edges.

Each round is a join and a partial aggregate; lineage is cut every few rounds by reliable checkpoints.
"""

from __future__ import annotations

import pickle
import random
import tempfile
import uuid
from collections.abc import Callable, Iterator
from itertools import count
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.errors import StoreError

DAMPING, ROUNDS = 0.85, 20
#: Edges up to which each betweenness task may hold the whole adjacency (twelve bytes an edge).
LOCAL_EDGES = 5_000_000
CUT_EVERY = 5


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; local sessions may go without a name."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise StoreError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="loomgraph-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def shared(df: DataFrame) -> DataFrame:
    """A reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Dealt:
    """Tables in the shared folder, bucketed by a column, so that joins and groupings by it move nothing.  For ``with``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def __enter__(self) -> Dealt:
        return self

    def by(self, df: DataFrame, column: str) -> DataFrame:
        name = f"loomgraph_{uuid.uuid4().hex}"
        path = f"{shared_dir(self.spark)}/{name}"
        self.held.append((name, path))
        df.repartition(self.buckets, column).write.format("parquet").option("path", path).bucketBy(self.buckets, column).sortBy(column).saveAsTable(name)
        return self.spark.table(name)

    def __exit__(self, *_: object) -> None:
        for name, path in self.held:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("source").alias("name")).unionByName(edges.select(F.col("target").alias("name"))).distinct()


def pagerank(edges: DataFrame, vertices: DataFrame | None = None, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """name, pagerank: (1 - d) + d * sum of rank / out-degree; what vertices without out-edges hold is lost.

    weight is the number of parallel edges.  The edges' shares are computed once, for numbered vertices, and stored bucketed
    by source, the vertices by number.  What flows in a round is summed per target, and that sum is dealt as the next round
    needs it: partial sums are all that moves.
    """
    vertices = vertices if vertices is not None else vertices_of(edges)
    names = numbered(vertices)
    u, v = (names.select(F.col("name").alias(side), F.col("number").alias(n)) for side, n in (("source", "u"), ("target", "v")))
    with Dealt(edges.sparkSession) as tables:
        out = edges.groupBy("source").agg(F.sum("weight").alias("out"))
        coded = edges.join(out, "source").join(u, "source").join(v, "target")
        share = tables.by(coded.select("u", "v", (F.col("weight") / F.col("out")).alias("share")), "u")
        every = tables.by(names.select("number"), "number")
        ranks = every.withColumn("pagerank", F.lit(1.0 - damping))
        # Round 0 holds the base everywhere; every further round adds what flows in.
        for i in range(rounds):
            flow = share.join(ranks, share.u == ranks.number).groupBy("v").agg(F.sum(F.col("share") * F.col("pagerank")).alias("flow"))
            ranks = every.join(flow, every.number == flow.v, "left").select("number", (F.lit(1.0 - damping) + F.lit(damping) * F.coalesce("flow", F.lit(0.0))).alias("pagerank"))
            if (i + 1) % CUT_EVERY == 0 and i + 1 < rounds:
                ranks = shared(ranks)
        return shared(names.join(ranks, "number").select("name", "pagerank"))


def numbered(names: DataFrame) -> DataFrame:
    """name, number: 0, 1, ... in order of name, without a single task: ranges are counted, then offset."""
    ordered = shared(names.select("name").distinct().sort("name").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low")).orderBy("part").collect()  # one row a partition
    shift, before = [], 0
    for r in parts:
        shift.append(F.when(F.col("part") == r.part, F.col("at") - F.lit(r.low) + F.lit(before)))
        before += r.n
    return ordered.select("name", (F.coalesce(*shift) if shift else F.lit(0)).cast("bigint").alias("number"))


class Adjacency:
    """Edges of a component both ways, and as rows of at most ``WIDE`` ends for sums over whole blocks of vertices."""

    def __init__(self, n: int, u: np.ndarray, v: np.ndarray):
        self.n, self.edges = n, len(u)
        self.out, self.into = self._by(u, v), self._by(v, u)
        self.most_in = int(self.into[3].max()) if n else 0

    def _by(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
        order = np.argsort(a, kind="stable")
        ends, degree = b[order].astype(np.intp), np.bincount(a, minlength=self.n)
        start = np.concatenate([[0], np.cumsum(degree)])
        # A vertex with many ends has several rows, so that no block waits for a hub.
        parts = -(-degree // WIDE)
        owner = np.repeat(np.arange(self.n), parts)
        low = start[owner] + WIDE * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
        width = np.minimum(start[owner + 1] - low, WIDE)
        most = np.argsort(-width, kind="stable")
        blocks = []
        for at in range(0, len(most), TALL):
            rows = most[at : at + TALL]
            counts = np.searchsorted(-width[rows], -np.arange(width[rows[0]]))  # rows with more than j ends
            blocks.append((owner[rows], bool((parts[owner[rows]] > 1).any()), [ends[low[rows[:m]] + j] for j, m in enumerate(counts)]))
        return start, ends, blocks, degree

    def summed(self, side: tuple, x: np.ndarray) -> np.ndarray:
        """For each vertex the sum of x (vertices by sources) over its ends."""
        out, held, part = np.zeros_like(x), np.empty((TALL, x.shape[1]), x.dtype), np.empty((TALL, x.shape[1]), x.dtype)
        for owner, shared_rows, ends in side[2]:
            np.take(x, ends[0], axis=0, out=part[: len(owner)], mode="clip")
            for e in ends[1:]:
                np.take(x, e, axis=0, out=held[: len(e)], mode="clip")
                part[: len(e)] += held[: len(e)]
            if shared_rows:
                np.add.at(out, owner, part[: len(owner)])
            else:
                out[owner] = part[: len(owner)]
        return out

    def along(self, side: tuple, pairs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ends each pair (vertex * width + source) has, and all these ends, pair by pair."""
        v, s = np.divmod(pairs, width)
        count = side[3][v]
        at = np.repeat(side[0][v] - np.cumsum(count) + count, count)
        at += np.arange(len(at))
        ends = side[1][at]
        ends *= width
        ends += np.repeat(s, count)
        return count, ends


#: Ends in a row, rows in a block, sources searched at once, and how many sums of whole blocks one end alone costs.
WIDE, TALL, AT_ONCE, ALONE = 64, 512, 64, 15
#: Cells (vertices by sources) that a search holds at most, and ends that it keeps for its way back.
CELLS, KEPT = 1 << 25, 1 << 22


def _local_brandes(held: Adjacency, sources: np.ndarray) -> np.ndarray:
    """Sums of dependencies over the given sources, ``AT_ONCE`` at a time, fewer where vertices are many.

    A step from one depth to the next runs along the edges of the pairs (vertex, source) on either of its sides, or over all
    edges for all sources at once, whichever is less work.
    """
    score = np.zeros(held.n)
    width = max(1, min(AT_ONCE, CELLS // max(1, held.n)))
    for low in range(0, len(sources), width):
        score += _dependencies(held, sources[low : low + width])
    return score


def _sums(count: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sums of x over runs of ``count`` values each."""
    out, some = np.zeros(len(count)), np.flatnonzero(count)
    if len(some):
        out[some] = np.add.reduceat(x, (np.cumsum(count) - count)[some])
    return out


def _dependencies(held: Adjacency, some: np.ndarray) -> np.ndarray:
    n, width = held.n, len(some)
    distance, paths = np.full(n * width, -1, np.int16 if n < 1 << 15 else np.int32), np.zeros(n * width)
    front = some * width + np.arange(width)
    distance[front], paths[front] = 0, 1.0
    # Of each depth its pairs, where they are listed, how many a vertex has, and the ends that led on from it, where kept.
    levels, kept, room, whole = [front], [], KEPT, held.edges * width / ALONE
    counts = [np.bincount(some, minlength=n)]
    left = width - counts[0]
    while counts[-1].any():
        depth, most, ends = len(levels), 0.0, None
        push, pull = int(counts[-1] @ held.out[3]), int(left @ held.into[3])
        if min(push, pull) > whole:
            before = np.where(distance == depth - 1, paths, 0.0)
            most = before.max() * held.most_in
            # Numbers of paths are whole: so small ones are exact in fewer bytes.
            small = np.uint16 if most < 1 << 16 else np.float32 if most < 1 << 24 else np.float64
            flow = held.summed(held.into, before.astype(small).reshape(n, width)).ravel()
            fresh = (flow > 0) & (distance < 0)
            flow *= fresh
            paths += flow
            distance += fresh * distance.dtype.type(depth + 1)
            front = None
        elif push <= pull:
            if levels[-1] is None:
                levels[-1] = np.flatnonzero(distance == depth - 1)
            count, ends = held.along(held.out, levels[-1], width)
            each = np.repeat(paths[levels[-1]], count)
            if len(ends) * 32 < n * width:
                new = distance[ends] < 0
                front, at = np.unique(ends[new], return_inverse=True)
                paths[front] = np.bincount(at, each[new], len(front))
                distance[front] = depth
            else:
                flow = np.bincount(ends, each, n * width)
                fresh = distance < 0
                flow *= fresh
                paths += flow
                fresh &= flow > 0
                distance += fresh * distance.dtype.type(depth + 1)
                front = None
            ends = (count, ends) if len(ends) <= room else None
            room -= len(ends[1]) if ends else 0
        else:
            rest = np.flatnonzero(distance < 0)
            count, into = held.along(held.into, rest, width)
            flow = _sums(count, (distance[into] == depth - 1) * paths[into])
            front = rest[flow > 0]
            paths[front] = flow[flow > 0]
            distance[front] = depth
        counts.append(np.bincount(front // width, minlength=n) if front is not None else (distance == depth).reshape(n, width).sum(axis=1))
        left -= counts[-1]
        kept.append(ends)
        levels.append(front)
    gained = np.zeros(n * width)
    np.maximum(paths, 1, out=paths)
    for depth in range(len(levels) - 2, 1, -1):  # what the sources themselves gain does not count
        down, up = int(counts[depth - 1] @ held.out[3]), int(counts[depth] @ held.into[3])
        over_all = kept[depth - 1] is None and min(down, up) > whole
        if over_all or levels[depth] is None:
            share = gained + 1
            share *= distance == depth
            share /= paths
        else:
            share = np.zeros(n * width)
            share[levels[depth]] = (1 + gained[levels[depth]]) / paths[levels[depth]]
        if over_all:
            got = held.summed(held.out, share.reshape(n, width)).ravel()
            got *= distance == depth - 1
            got *= paths
            gained += got
            continue
        above = levels[depth - 1] if levels[depth - 1] is not None else np.flatnonzero(distance == depth - 1)
        if kept[depth - 1] is None and up <= down:
            below = levels[depth] if levels[depth] is not None else np.flatnonzero(distance == depth)
            count, ends = held.along(held.into, below, width)
            right = distance[ends] == depth - 1
            got = np.bincount(ends[right], np.repeat(share[below], count)[right], n * width)[above]
        else:
            count, ends = kept[depth - 1] or held.along(held.out, above, width)
            got = _sums(count, share[ends])
        gained[above] = paths[above] * got
    return gained.reshape(n, width).sum(axis=1)


def _components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Of each vertex the smallest one that it hangs together with, whichever way edges lead."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[u], label[v])
        np.minimum.at(label, before[u], least)
        np.minimum.at(label, before[v], least)
        while not np.array_equal(label, up := label[label]):
            label = up
        if np.array_equal(label, before):
            return label


def betweenness(edges: DataFrame, normalized: bool = False, sample: int | None = None, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """name, betweenness of directed, unweighted edges (Brandes).

    Sources are dealt over tasks.  Up to ``local_edges`` edges a task holds the adjacency itself, component by component, for
    no path leaves its component; beyond that the search runs as joins over frontiers.  sample: so many sources, evenly
    spaced, their sum scaled up; all of them by default.
    """
    pairs = shared(edges.select("source", "target").where("source <> target").distinct())
    names = numbered(vertices_of(edges))
    ends = names.withColumnRenamed("name", "source").withColumnRenamed("number", "u"), names.withColumnRenamed("name", "target").withColumnRenamed("number", "v")
    coded = shared(pairs.join(ends[0], "source").join(ends[1], "target").select("u", "v"))
    return _betweenness(names, names.count(), coded, normalized, sample, local_edges)


def _betweenness(names: DataFrame, n: int, coded: DataFrame, normalized: bool = False, sample: int | None = None, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """betweenness() over numbered pairs (u, v), each there once and none a loop."""
    spark = names.sparkSession
    sources = np.arange(n) if not sample or sample >= n else np.array([int(i * n / sample) for i in range(sample)])
    scale = n / sample if sample and sample < n else 1.0
    if coded.count() <= local_edges:
        arrays = coded.toArrow()  # two numbers an edge; as rows they would take the driver many times more
        u, v = arrays["u"].to_numpy(), arrays["v"].to_numpy()
        component = _components(n, u, v)
        # Vertices in order of component, so that each has a range of them and of edges.
        order = np.argsort(component, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        by = np.argsort(place[u], kind="stable")
        u, v = place[u][by].astype(np.int32), place[v][by].astype(np.int32)
        first = np.flatnonzero(np.diff(component[order], prepend=-1))
        bounds, begins = np.append(first, n), np.searchsorted(u, np.append(first, n))
        held = spark.sparkContext.broadcast((u, v, bounds, begins, order))
        tasks = min(max(1, n // 50), 8 * spark.sparkContext.defaultParallelism)
        at = np.sort(place[sources])
        size = max(1, -(-len(at) // tasks))
        runs = [(i, at[i * size : (i + 1) * size].astype(np.int32).tobytes()) for i in range(-(-len(at) // size))]

        def search(run: tuple[int, bytes]) -> Iterator[tuple[int, bytes, bytes]]:
            u, v, bounds, begins, order = held.value
            mine = np.frombuffer(run[1], np.int32).astype(np.int64)
            which = np.searchsorted(bounds, mine, "right") - 1
            for c in np.unique(which):
                low, high, a, b = bounds[c], bounds[c + 1], begins[c], begins[c + 1]
                if a < b:
                    score = _local_brandes(Adjacency(high - low, u[a:b] - low, v[a:b] - low), mine[which == c] - low)
                    some = np.flatnonzero(score)
                    yield int(c), order[low + some].tobytes(), score[some].tobytes()

        def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for x, y in zip(b["number"], b["score"], strict=True):
                    yield pd.DataFrame({"number": np.frombuffer(x, np.int64), "score": np.frombuffer(y)})

        found = spark.createDataFrame(spark.sparkContext.parallelize(runs, max(1, len(runs))).flatMap(search), "c int, number binary, score binary")
        raw = found.mapInPandas(unpacked, "number long, score double")
    else:
        raw = frontier_brandes(coded, spark.range(n) if len(sources) == n else spark.createDataFrame([(int(i),) for i in sources], "id long"))
    sums = raw.groupBy("number").agg(F.sum("score").alias("score"))
    factor = scale / ((n - 1) * (n - 2)) if normalized and n > 2 else scale
    return names.join(sums, "number", "left").select("name", (F.coalesce("score", F.lit(0.0)) * F.lit(factor)).alias("betweenness"))


def frontier_brandes(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """number, score of edges (u, v) for the sources (id), as joins: a level's rows are (source, vertex, distance, paths)."""
    levels = [shared(sources.select(F.col("id").alias("s"), F.col("id").alias("w"), F.lit(1.0).alias("paths")))]
    seen = levels[0].select("s", "w")
    while True:
        step = levels[-1].join(edges, F.col("w") == F.col("u")).groupBy("s", F.col("v").alias("w")).agg(F.sum("paths").alias("paths"))
        fresh = shared(step.join(seen, ["s", "w"], "left_anti"))
        if fresh.isEmpty():
            break
        levels.append(fresh)
        seen = shared(seen.unionByName(fresh.select("s", "w")))
    below, total = None, None
    for level in reversed(levels):
        if below is None:
            now = level.withColumn("score", F.lit(0.0))
        else:
            lower = below.select("s", F.col("w").alias("v"), F.col("paths").alias("their_paths"), F.col("score").alias("their_score"))
            gained = level.join(edges, F.col("w") == F.col("u")).join(lower, ["s", "v"]).groupBy("s", "w").agg(F.sum(F.col("paths") / F.col("their_paths") * (1 + F.col("their_score"))).alias("score"))
            now = level.join(gained, ["s", "w"], "left").na.fill(0.0, ["score"])
        below = shared(now)
        part = below.where("s <> w").select(F.col("w").alias("number"), "score")
        total = part if total is None else total.unionByName(part)
    return total


def _flags(edges: DataFrame) -> DataFrame:
    """Undirected, each edge in both directions, weights of parallel edges summed; a loop once with twice its weight."""
    a = edges.select("source", "target", F.col("weight").cast("double").alias("weight"))
    both = a.unionByName(a.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight"))
    return both.groupBy("source", "target").agg(F.sum("weight").alias("weight"))


#: The gain of modularity that is none, after how many rounds without one a pass ends, and what sums may be off.
LEAST_GAIN, IDLE_ROUNDS, ROUNDING = 1e-3, 2, 1e-12
#: Edges of a block, and vertices up to which each task is sent all places and degrees (twelve bytes a vertex).
BLOCK_EDGES, HELD_VERTICES = 1_000_000, 10_000_000
#: A move counts from this gain on, in edge weights.
LEAST_MOVE = 1e-9
PRIME = 2_147_483_647

#: Adjacency of some vertices: them, where their edges begin, the edges' other ends and weights.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _draw(seed: int, p: int, r: int) -> int:
    """By it the vertices that may move in a round are drawn: those v for which v + 1 times it, modulo PRIME, is even."""
    return random.Random(f"{seed} {p} {r}").randrange(1, PRIME)


def _merged(u: np.ndarray, v: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """u, v, weight in order, weights of equal pairs summed."""
    key = u.astype(np.int64) * n + v
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    sums = np.add.reduceat(weight[order].astype(np.float64), first) if len(first) else np.zeros(0)
    u, v = np.divmod(key[first], n)
    return u.astype(np.int32), v.astype(np.int32), sums


def _block(u: np.ndarray, v: np.ndarray, weight: np.ndarray, n: int) -> Block:
    u, v, weight = _merged(u, v, weight, n)
    head, start = np.unique(u, return_index=True)
    small = weight.astype(np.float32)
    return head, np.append(start, len(u)), v, small if (small == weight).all() else weight


def _degrees(block: Block) -> tuple[np.ndarray, np.ndarray]:
    head, start, _, weight = block
    return head, np.add.reduceat(weight.astype(np.float64), start[:-1]) if len(head) else np.zeros(0)


def _moves(block: Block, at: np.ndarray, k: np.ndarray, size: np.ndarray, total: float, draw: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Of the block's vertices those that move, where to, and the weight within communities so far.  Of equal gains staying wins, then the smaller number."""
    head, start, target, weight = block
    n = len(at)
    mine = (head.astype(np.int64) + 1) * draw % PRIME % 2 == 0
    own = np.flatnonzero(mine)
    rows = np.repeat(np.arange(len(head)), np.diff(start))
    inside = float(weight[at[head][rows] == at[target]].sum(dtype=np.float64))
    keep = mine[rows] & (target != head[rows])
    rows, to, links = _merged(np.concatenate([rows[keep], own]), np.concatenate([at[target[keep]], at[head[own]]]), np.concatenate([weight[keep], np.zeros(len(own))]), n)
    if not len(rows):
        return np.zeros(0, np.int32), np.zeros(0, np.int32), inside
    v = head[rows]
    same = to == at[v]
    gain = links - k[v] * np.where(same, size[to] - k[v], size[to]) / total
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    best, stay = np.maximum.reduceat(gain, first), gain[same]
    place = np.where(gain == np.repeat(best, np.diff(np.append(first, len(rows)))), np.arange(len(rows)), len(rows))
    goes = best - stay > LEAST_MOVE
    return v[first][goes], to[np.minimum.reduceat(place, first)][goes], inside


def _contracted(block: Block, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    head, start, target, weight = block
    return _merged(np.repeat(at[head], np.diff(start)), at[target], weight, len(at))


class Course:
    """Of a pass: its best state but the beginning, and whether it is over.

    Gains that vertices expect do not add up, for neighbours move in the same round.  So states are judged by their modularity,
    and a pass is over after ``IDLE_ROUNDS`` states without ``LEAST_GAIN``.  Modularity is at most 1, so every pass ends.
    """

    def __init__(self) -> None:
        self.best: Any = None
        self.first = self.most = self.mark = -np.inf
        self.states = self.idle = 0

    def over(self, state: Any, modularity: float) -> bool:
        if not self.states:
            self.first = modularity
        elif modularity > self.most + ROUNDING:
            self.best, self.most = state, modularity
        if modularity >= self.mark + LEAST_GAIN:
            self.mark, self.idle = modularity, 0
        else:
            self.idle += 1
        self.states += 1
        return self.idle >= IDLE_ROUNDS


class Top:
    """The best of all passes.  They go on while communities get fewer, so they end, and may lead through worse ones."""

    def __init__(self, member: Any) -> None:
        self.member, self.modularity = member, -np.inf

    def see(self, member: Any, modularity: float) -> None:
        if modularity > self.modularity + ROUNDING:
            self.member, self.modularity = member, modularity


def _pass(n: int, k: np.ndarray, total: float, draws: Iterator[int], moves: Callable[..., list[tuple[np.ndarray, np.ndarray, float]]]) -> Course:
    """moves: those of all blocks, given places and draw."""
    at, course = np.arange(n, dtype=np.int32), Course()
    while True:
        found = moves(at, next(draws))
        size = np.bincount(at, k, n) / total
        if course.over(at, sum(inside for _, _, inside in found) / total - float(size @ size)):
            return course
        at = at.copy()
        for v, to, _ in found:
            at[v] = to


def _fewer(at: np.ndarray, k: np.ndarray) -> bool:
    """Whether the vertices of a level, those with a degree, are in fewer places than they are."""
    there = k > 0
    return len(np.unique(at[there])) < there.sum()


def _packed(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From a partition's edges (u, v, weight) to its block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b["u"].to_numpy().astype(np.int32), b["v"].to_numpy().astype(np.int32), b["weight"].to_numpy()) for b in batches if len(b)]
        if parts:
            yield _row(pickle.dumps(_block(*(np.concatenate(x) for x in zip(*parts, strict=True)), n), 5))

    return pack


def _row(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["block"])


def _blocks(rows: DataFrame, n: int, count: int, at_once: int) -> DataFrame:
    """One block a partition; rows (u, v, weight), of which there are ``count``, are dealt by u, small blocks over ``at_once`` tasks."""
    tasks = max(1, -(-count // BLOCK_EDGES), min(at_once, -(-20 * count // BLOCK_EDGES)))
    return shared(rows.repartition(tasks, "u").mapInArrow(_packed(n), "block binary"))


def _each(blocks: DataFrame, f: Callable[[Block], Any]) -> list[Any]:
    """f of every block, to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b["block"]:
                yield _row(pickle.dumps(f(pickle.loads(x.as_buffer())), 5))

    return [pickle.loads(r.block) for r in blocks.mapInArrow(run, "block binary").collect()]


def _over_tasks(blocks: DataFrame, n: int, total: float, seed: int) -> np.ndarray:
    """The community of each of n vertices, rounds as jobs over blocks; the driver has each vertex's place and degree."""
    context = blocks.sparkSession.sparkContext
    member = np.arange(n, dtype=np.int32)
    top = Top(member)
    for p in count():
        if p and blocks.rdd.getNumPartitions() == 1:  # so small a level is settled faster where it lies
            for at, modularity in _each(blocks, lambda block, p=p: _in_memory([block], n, total, seed, p)):
                top.see(at[member], modularity)
            return top.member
        k = np.zeros(n)
        for v, weight in _each(blocks, _degrees):
            k[v] = weight
        degrees = context.broadcast(k)

        def moves(at: np.ndarray, draw: int, blocks: DataFrame = blocks, degrees: Broadcast = degrees) -> list[tuple[np.ndarray, np.ndarray, float]]:
            places = context.broadcast(at)
            out = _each(blocks, lambda block: _moves(block, places.value, degrees.value, np.bincount(places.value, degrees.value, n), total, draw))
            places.destroy()
            return out

        course = _pass(n, k, total, (_draw(seed, p, r) for r in count()), moves)
        degrees.destroy()
        at = course.best
        top.see(member, course.first)
        if not _fewer(at, k):
            return top.member
        member = at[member]
        top.see(member, course.most)
        places = context.broadcast(at)

        def contract(batches: Iterator[pa.RecordBatch], places: Broadcast = places) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for x in b["block"]:
                    yield pa.RecordBatch.from_arrays([pa.array(y) for y in _contracted(pickle.loads(x.as_buffer()), places.value)], ["u", "v", "weight"])

        rows = shared(blocks.mapInArrow(contract, "u int, v int, weight double"))
        blocks = _blocks(rows, n, rows.count(), 1)


def _in_memory(blocks: list[Block], n: int, total: float, seed: int, first: int = 0) -> tuple[np.ndarray, float]:
    """As _over_tasks(), with the blocks at hand, from pass ``first`` on; and the modularity."""
    member = np.arange(n, dtype=np.int32)
    top = Top(member)
    for p in count(first):
        k = np.zeros(n)
        for v, weight in map(_degrees, blocks):
            k[v] = weight

        def moves(at: np.ndarray, draw: int, blocks: list[Block] = blocks, k: np.ndarray = k) -> list[tuple[np.ndarray, np.ndarray, float]]:
            size = np.bincount(at, k, n)
            return [_moves(b, at, k, size, total, draw) for b in blocks]

        course = _pass(n, k, total, (_draw(seed, p, r) for r in count()), moves)
        at = course.best
        top.see(member, course.first)
        if not _fewer(at, k):
            return top.member, top.modularity
        member = at[member]
        top.see(member, course.most)
        # A block goes when its part of the next level is there; parts are dealt by ranges of vertices and put together.
        ranges = [[] for _ in blocks]
        bounds = np.linspace(0, n, len(blocks) + 1)[1:-1]
        for i in range(len(blocks)):
            u, v, weight = _contracted(blocks[i], at)
            blocks[i] = None
            small = weight.astype(np.float32)
            weight = small if (small == weight).all() else weight
            cuts = [0, *np.searchsorted(u, bounds), len(u)]
            for held, a, b in zip(ranges, cuts[:-1], cuts[1:], strict=True):
                held.append((u[a:b].copy(), v[a:b].copy(), weight[a:b].copy()))
        blocks = []
        while ranges:
            blocks.append(_block(*(np.concatenate(x) for x in zip(*ranges.pop(), strict=True)), n))


def _coded(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """name, number of all ends, and the edges in both directions as (u, v, weight); a loop is there twice."""
    names = numbered(vertices_of(edges))
    ends = (names.select(F.col("name").alias(side), F.col("number").alias(n)) for side, n in (("source", "u"), ("target", "v")))
    once = edges.select("source", "target", F.col("weight").cast("double").alias("weight"))
    once = shared(once.join(next(ends), "source").join(next(ends), "target").select("u", "v", "weight"))
    return names, once.unionByName(once.select(F.col("v").alias("u"), F.col("u").alias("v"), "weight"))


def _communities(edges: DataFrame, settle: Callable[[DataFrame, int, float], np.ndarray]) -> DataFrame:
    """name, community: by the smallest number in each of the communities that settle() finds in blocks."""
    names, flat = _coded(edges)
    return _held_communities(names, flat, names.count(), settle)


def _held_communities(names: DataFrame, flat: DataFrame, n: int, settle: Callable[[DataFrame, int, float], np.ndarray]) -> DataFrame:
    sums = flat.agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("rows")).first()
    member = settle(_blocks(flat, n, sums.rows, names.sparkSession.sparkContext.defaultParallelism), n, sums.total) if sums.total else np.arange(n, dtype=np.int32)
    first = np.full(n, n, np.int32)
    np.minimum.at(first, member, np.arange(n, dtype=np.int32))
    held = names.sparkSession.sparkContext.broadcast(first[member])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["name"], pa.array(held.value[b["number"].to_numpy()], pa.int64())], ["name", "first"])

    of = names.mapInArrow(place, "name string, first long")
    return of.join(names.select(F.col("number").alias("first"), F.col("name").alias("community")), "first").select("name", "community")


def louvain_in_one_task(edges: DataFrame, seed: int = 1) -> DataFrame:
    """As louvain(), the same moves, all in one task, which holds eight bytes for each edge and direction: for graphs that the caller knows to fit."""

    def settle(blocks: DataFrame, n: int, total: float) -> np.ndarray:
        alone = lambda rows: [pickle.dumps(_in_memory([pickle.loads(r.block) for r in rows], n, total, seed)[0], 5)]
        return pickle.loads(blocks.rdd.coalesce(1).mapPartitions(alone).first())

    return _communities(edges, settle)


def louvain(edges: DataFrame, seed: int = 1, held_vertices: int = HELD_VERTICES) -> DataFrame:
    """name, community: communities of locally large modularity, named by their smallest member.

    In each round about half the vertices, drawn by hash, may move to the neighbouring community with the largest gain, so
    two neighbours seldom swap.  A pass ends when modularity has not risen by ``LEAST_GAIN`` in ``IDLE_ROUNDS`` rounds; then
    the communities of its best round become vertices and the next pass begins, until there are no fewer.  The best of all counts.  The edges lie in blocks by vertex, each
    read by a task in a round, and never move within a pass: up to ``held_vertices`` vertices, their places are sent to the
    tasks and the moves returned.  Beyond, the same moves are joins.
    """
    names, flat = _coded(edges)
    return _louvain(names, names.count(), flat, seed, held_vertices)


def _louvain(names: DataFrame, n: int, flat: DataFrame, seed: int = 1, held_vertices: int = HELD_VERTICES) -> DataFrame:
    """louvain() over numbered edges in both directions."""
    if n <= held_vertices:
        return _held_communities(names, flat, n, lambda blocks, n, total: _over_tasks(blocks, n, total, seed))
    level = shared(flat.groupBy("u", "v").agg(F.sum("weight").alias("weight")))
    total = level.agg(F.sum("weight").alias("t")).first().t
    at = names.select("number", F.col("number").alias("at"))
    top = Top(at)
    for p in count() if total else ():
        course = _settled(level, total, seed, p)
        member = course.best
        top.see(at, course.first)
        ends = member.agg(F.count(F.lit(1)).alias("all"), F.count_distinct("c").alias("places")).first()
        if ends.places == ends.all:
            break
        to = member.select(F.col("v").alias("at"), "c")
        at = shared(at.join(to, "at", "left").select("number", F.coalesce("c", "at").alias("at")))
        top.see(at, course.most)
        level = shared(
            level.join(member.select(F.col("v").alias("u"), F.col("c").alias("a")), "u")
            .join(member.select("v", F.col("c").alias("b")), "v")
            .groupBy(F.col("a").alias("u"), F.col("b").alias("v"))
            .agg(F.sum("weight").alias("weight"))
        )
    at = top.member
    first = at.groupBy("at").agg(F.min("number").alias("first"))
    first = first.join(names.select(F.col("number").alias("first"), F.col("name").alias("community")), "first")
    return at.join(first, "at").join(names, "number").select("name", "community")


def _settled(level: DataFrame, total: float, seed: int, p: int) -> Course:
    """A pass; its states are v, k, c of each vertex."""
    degree = shared(level.groupBy(F.col("u").alias("v")).agg(F.sum("weight").alias("k")))
    member, course = degree.select("v", "k", F.col("v").alias("c")), Course()
    apart = level.where("u <> v")
    for r in count():
        ends = level.join(member.select(F.col("v").alias("u"), F.col("c").alias("a")), "u").join(member.select("v", F.col("c").alias("b")), "v")
        inside = ends.where("a = b").agg(F.sum("weight")).first()[0] or 0.0
        square = member.groupBy("c").agg(F.sum("k").alias("size")).agg(F.sum(F.col("size") * F.col("size"))).first()[0]
        if course.over(member, inside / total - square / total**2):
            return course
        size = member.groupBy(F.col("c").alias("to")).agg(F.sum("k").alias("size"))
        links = apart.join(member.select("v", F.col("c").alias("to")), "v").groupBy(F.col("u").alias("v"), "to").agg(F.sum("weight").alias("w"))
        mine = member.where((F.col("v") + 1) * F.lit(_draw(seed, p, r)) % PRIME % 2 == 0)
        choice = mine.select("v", "k", "c", F.col("c").alias("to"), F.lit(0.0).alias("w")).unionByName(mine.join(links, "v").select("v", "k", "c", "to", "w"))
        choice = choice.groupBy("v", "k", "c", "to").agg(F.sum("w").alias("w")).join(size, "to")
        inside = F.when(F.col("to") == F.col("c"), F.col("size") - F.col("k")).otherwise(F.col("size"))
        gain = F.col("w") - F.col("k") * inside / F.lit(total)
        staying = F.max(F.when(F.col("to") == F.col("c"), gain))
        best = choice.groupBy("v").agg(F.max(F.struct(gain.alias("gain"), (F.col("to") == F.col("c")).alias("stay"), (-F.col("to")).alias("to"))).alias("best"), staying.alias("staying"))
        best = best.select("v", (-F.col("best.to")).alias("to"), (F.col("best.gain") - F.col("staying")).alias("more")).where(F.col("more") > LEAST_MOVE)
        member = shared(member.join(best, "v", "left").select("v", "k", F.coalesce("to", "c").alias("c")))


def modularity(edges: DataFrame, communities: DataFrame) -> float:
    flat = _flags(edges)
    of = communities.select("name", "community")
    rows = flat.join(of.withColumnRenamed("name", "source").withColumnRenamed("community", "a"), "source").join(of.withColumnRenamed("name", "target").withColumnRenamed("community", "b"), "target")
    total = flat.agg(F.sum("weight").alias("t")).first().t
    inside = rows.where("a = b").agg(F.sum("weight").alias("w")).first().w or 0.0
    square = rows.groupBy("a").agg(F.sum("weight").alias("k")).agg(F.sum(F.col("k") * F.col("k")).alias("s")).first().s
    return inside / total - square / total**2


def _pagerank_in_blocks(names: DataFrame, n: int, coded: DataFrame, without: int | None, rounds: int, damping: float) -> DataFrame:
    """pagerank() over numbered edges (u, v, weight), which lie in blocks by target; the driver has two numbers of a vertex.

    In a round the tasks are sent what each vertex gives to a unit of weight, and return what their targets get.
    """
    out = np.ones(n)
    sums = coded.groupBy("u").agg(F.sum("weight").alias("out")).toArrow()
    out[sums["u"].to_numpy()] = sums["out"].to_numpy()
    if without is not None:
        out[without] = np.inf
    context = names.sparkSession.sparkContext
    into = coded.where("v is not null").select(F.col("v").alias("u"), F.col("u").alias("v"), F.col("weight").cast("double").alias("weight"))
    blocks = _blocks(into, n, into.count(), context.defaultParallelism)
    ranks = np.full(n, 1.0 - damping)
    for _ in range(rounds):
        gives = context.broadcast(ranks / out)
        ranks = np.full(n, 1.0 - damping)
        for v, flow in _each(blocks, lambda b, gives=gives: (b[0], np.add.reduceat(b[3] * gives.value[b[2]], b[1][:-1]))):
            ranks[v] += damping * flow
        gives.destroy()
    held = context.broadcast(ranks)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["name"], pa.array(held.value[b["number"].to_numpy()])], ["name", "pagerank"])

    return names.mapInArrow(place, "name string, pagerank double")


def central(edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, held_vertices: int = HELD_VERTICES) -> DataFrame:
    """name, pagerank, community, betweenness of the vertices that edges have: the three metrics over one numbering.

    edges: each pair of source and target once.  An end with an empty name is a vertex of paths and communities, but has no
    rank, gives none and is not returned.
    """
    names = numbered(vertices_of(edges).where("name is not null"))
    n = names.count()
    u, v = (names.select(F.col("name").alias(side), F.col("number").alias(k)) for side, k in (("source", "u"), ("target", "v")))
    coded = shared(edges.join(u, "source").join(v, "target", "left").select("u", "v", "weight"))
    whole = coded.where("v is not null")
    if n <= held_vertices:
        first = names.where("number = 0").first()  # in order of name, none comes first
        ranks = _pagerank_in_blocks(names, n, coded, 0 if first and not first.name else None, rounds, damping)
    else:
        ranks = pagerank(edges, names.select("name").where("name <> ''"), rounds, damping)
    once = whole.select("u", "v", F.col("weight").cast("double").alias("weight"))
    groups = _louvain(names, n, once.unionByName(once.select(F.col("v").alias("u"), F.col("u").alias("v"), "weight")), held_vertices=held_vertices)
    paths = _betweenness(names, n, whole.where("u <> v").select("u", "v"))
    return ranks.where("name <> ''").join(paths, "name").join(groups, "name")


METRICS = {"pagerank": pagerank, "betweenness": betweenness, "community": louvain}
#: What a run computes, by the name of the choice; an unknown choice counts as all.
METRIC_SETS = {"all": ("pagerank", "betweenness", "community"), "fast": ("pagerank",), "none": ()}


def compute(edges: DataFrame, choice: str = "all") -> dict[str, DataFrame | Exception]:
    """The chosen metrics, computed; one that fails is its exception and does not keep the others from being computed."""
    out: dict[str, DataFrame | Exception] = {}
    for name in METRIC_SETS.get(choice, METRIC_SETS["all"]):
        try:
            out[name] = shared(METRICS[name](edges))
        except Exception as e:  # noqa: BLE001  (reported to the caller)
            out[name] = e
    return out


def over_whole_graph(links: list[DataFrame], choice: str = "all") -> dict[str, DataFrame | Exception]:
    """The chosen metrics over the union of all relations (source, target), betweenness normalized; callers keep what they need.

    Names must tell the kinds of vertices apart.
    """
    edges = None
    for link in links:
        one = link.select("source", "target").distinct().withColumn("weight", F.lit(1).cast("long"))
        edges = one if edges is None else edges.unionByName(one)
    edges = shared(edges.groupBy("source", "target").agg(F.sum("weight").alias("weight")))
    run = METRICS | {"betweenness": lambda e: betweenness(e, normalized=True)}
    out: dict[str, DataFrame | Exception] = {}
    for name in METRIC_SETS.get(choice, METRIC_SETS["all"]):
        try:
            out[name] = shared(run[name](edges))
        except Exception as e:  # noqa: BLE001  (reported to the caller)
            out[name] = e
    return out
