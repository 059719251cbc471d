"""Nearest neighbours by inner product with a forest of random-projection trees.

Vectors get one more component that makes all of them equally long, so that the largest inner product is the least
distance.  A tree splits its vectors at the median of their projections on the line between two centres of a random
part of them, until leaves are small; the splits of ``TREES`` trees are fitted on a sample of at most ``SAMPLE`` distinct
vectors, and then every vector is put into its leaf of every tree.  A query descends all trees through one shared
priority queue, which holds the nodes not yet visited by how far the query is from their side of the splits.  How much it
visits is measured over the whole table: the true neighbours of ``PROBES`` queries are found by an exact scan, and the reach
is such that the share ``RECALL`` of them is met.  Candidates in visited leaves are reranked by exact inner products.

Neighbouring leaves of a tree are dealt to tasks as one shard of about ``SHARD_ROWS`` vectors; a query goes to a shard once,
with the leaves it visits there, and gets one list of its best ``k`` back.  A leaf of more vectors is split by hash into
parts, and the queries of a shard into blocks of ``QUERY_ROWS``, so no task holds more than one of each.  Equal vectors are
one entry with its ``k + 1`` smallest ids: none but those can be among the k nearest, as ties go to the smaller id.

Defined results: vectors that are null, zero, or hold a null or non-finite component take no part, neither do those of
another width than most have, nor null ids; of a vec_id's different vectors the smallest counts; fewer than k candidates
give fewer rows; repeated rows count once; empty input, empty output; vec_id is a whole number (others are cast to long, and
what is no number raises); other columns may have any names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import checkpointed, sliced

K = 20
EVERY = 20
TREES = 6
SAMPLE = 50_000
LEAF = 256
#: Share of the true neighbours that the reach must meet, and the number of queries it is measured with.
RECALL = 0.95
PROBES = 150
SHARD_ROWS = 20_000
QUERY_ROWS = 50_000
BLOCK = 4096
#: Candidates kept beyond k + 1 until scores are exact.
SPARE = 8


@dataclass
class Tree:
    """Inner nodes by number: normal and threshold, children (negative: leaf -1 - number)."""

    normals: np.ndarray
    cuts: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sizes: np.ndarray


def _direction(part: np.ndarray) -> np.ndarray:
    """From one to the other of two centres that a few rounds of averaging have drawn apart."""
    a, b = part[0].copy(), part[1].copy()
    for _ in range(8):
        near = ((part - a) ** 2).sum(1) < ((part - b) ** 2).sum(1)
        if near.all() or not near.any():
            break
        a, b = part[near].mean(0), part[~near].mean(0)
    return a - b


def _grown(points: np.ndarray, rng: np.random.Generator) -> Tree:
    normals, cuts, left, right, sizes = [], [], [], [], []
    todo = [(np.arange(len(points)), None, None)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        if len(rows) > LEAF:
            for _ in range(5):
                normal = _direction(points[rng.choice(rows, min(len(rows), 256), replace=False)])
                length = np.linalg.norm(normal)
                if length == 0:
                    continue
                normal = normal / length
                p = points[rows] @ normal
                cut = float(np.median(p))
                low = p <= cut
                if 0 < low.sum() < len(rows):
                    split = (normal, cut, low)
                    break
        if split is None:
            number = -1 - len(sizes)
            sizes.append(len(rows))
        else:
            number = len(cuts)
            normals.append(split[0])
            cuts.append(split[1])
            left.append(0)
            right.append(0)
            todo += [(rows[split[2]], number, left), (rows[~split[2]], number, right)]
        if parent is not None:
            side[parent] = number
    return Tree(np.array(normals, np.float64).reshape(len(cuts), points.shape[1]), np.array(cuts), np.array(left, int), np.array(right, int), np.array(sizes))


@dataclass
class Forest:
    trees: list[Tree]
    longest: float

    def raised(self, x: np.ndarray) -> np.ndarray:
        """With the component that makes vectors equally long."""
        return np.concatenate([x, np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(1)))[:, None]], axis=1)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        x = self.raised(x)
        out = np.zeros((len(x), len(self.trees)), np.int64)
        for t, tree in enumerate(self.trees):
            at = np.zeros(len(x), int) if len(tree.cuts) else np.full(len(x), -1)
            while (live := np.flatnonzero(at >= 0)).size:
                node = at[live]
                high = np.einsum("ij,ij->i", x[live], tree.normals[node]) > tree.cuts[node]
                at[live] = np.where(high, tree.right[node], tree.left[node])
            out[:, t] = -1 - at
        return out

    def visited(self, x: np.ndarray, reach: int) -> Iterator[list[tuple[int, int]]]:
        """(tree, leaf) pairs of each query, nearest first by the squared margins crossed on the way, summed."""
        q = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        sides = [q @ tree.normals.T - tree.cuts for tree in self.trees]
        for i in range(len(x)):
            queue = [(0.0, t, 0 if len(tree.cuts) else -1) for t, tree in enumerate(self.trees)]
            heapq.heapify(queue)
            held, out = 0, []
            while queue and held < reach:
                crossed, t, node = heapq.heappop(queue)
                tree = self.trees[t]
                while node >= 0:
                    side = sides[t][i, node]
                    near, far = (tree.right[node], tree.left[node]) if side > 0 else (tree.left[node], tree.right[node])
                    heapq.heappush(queue, (crossed + side * side, t, int(far)))
                    node = near
                out.append((t, int(-1 - node)))
                held += int(tree.sizes[-1 - node])
            yield out


def grown(sample: np.ndarray, longest: float, trees: int = TREES) -> Forest:
    forest = Forest([], longest)
    points = forest.raised(sample) if len(sample) else np.zeros((0, 2))
    forest.trees = [_grown(points, np.random.default_rng(100 + t)) for t in range(trees)]
    return forest


def measured_reach(forest: Forest, probes: np.ndarray, truth: list[np.ndarray]) -> int:
    """Vectors of the sample, summed over visited leaves, after which the share RECALL of true neighbours has been met.

    truth: for each probe the leaves of its true neighbours, a row each with one leaf a tree.
    """
    met = []
    for leaves, pairs in zip(truth, forest.visited(probes, 1 << 62), strict=True):
        when = [np.zeros(len(t.sizes), np.int64) for t in forest.trees]
        held = 0
        for t, n in pairs:
            held += int(forest.trees[t].sizes[n])
            when[t][n] = held
        if len(leaves):
            met.append(np.min([when[t][leaves[:, t]] for t in range(len(when))], axis=0))
    return int(np.quantile(np.concatenate(met), RECALL, method="higher")) if met else 1


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows; each is summed alone, so equal vectors give equal values wherever they stand."""
    return (a * b).sum(axis=1)


def best_of(queries: np.ndarray, vectors: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and exact score of the k + 1 best of every query (by score, then smallest id ``low``)."""
    rows, found, scores = [], [], []
    for s in range(0, len(queries), 256):
        q = queries[s : s + 256]
        rough = q @ vectors.T
        if rough.shape[1] > k + 1:
            least = np.partition(rough, -(k + 1), axis=1)[:, -(k + 1)]
            near = rough >= (least - 1e-9 * np.maximum(1, np.abs(least)))[:, None]
        else:
            near = np.ones(rough.shape, bool)
        i, j = np.nonzero(near)
        i, j, exact = _ranked(i, j, inner(q[i], vectors[j]), low, k)
        rows.append(i + s)
        found.append(j)
        scores.append(exact)
    if not rows:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def _ranked(i: np.ndarray, j: np.ndarray, exact: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((low[j], -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i, "left") < k + 1
    return i[keep], j[keep], exact[keep]


def best_in_leaves(queries: np.ndarray, wanted: tuple[np.ndarray, np.ndarray], vectors: np.ndarray, leaf: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As best_of(), each query only among the leaves it visits: wanted has pairs of a query and a leaf.

    Leaf by leaf, its vectors are multiplied with the queries that visit it, and each of these keeps its best.  A query whose
    kept candidates end in a tie is looked at once more, over all of its leaves.
    """
    size = k + 1 + SPARE
    top, which = np.full((len(queries), size), -np.inf), np.full((len(queries), size), -1, np.int64)
    by_leaf = np.argsort(leaf, kind="stable")
    by_wish = np.argsort(wanted[1], kind="stable")
    who, wish = wanted[0][by_wish], wanted[1][by_wish]
    for n in np.unique(leaf):
        members = by_leaf[np.searchsorted(leaf[by_leaf], n, "left") : np.searchsorted(leaf[by_leaf], n, "right")]
        asking = who[np.searchsorted(wish, n, "left") : np.searchsorted(wish, n, "right")]
        for s in range(0, len(asking), 512):
            q = asking[s : s + 512]
            for m in range(0, len(members), BLOCK):
                mine = members[m : m + BLOCK]
                rough = queries[q] @ vectors[mine].T
                better = rough.max(axis=1) > top[q].min(axis=1)
                if better.any():
                    u = q[better]
                    both = np.concatenate([top[u], rough[better]], axis=1)
                    ids = np.concatenate([which[u], np.broadcast_to(mine, (len(u), len(mine)))], axis=1)
                    best = np.argpartition(both, -size, axis=1)[:, -size:]
                    top[u], which[u] = np.take_along_axis(both, best, 1), np.take_along_axis(ids, best, 1)
    i, place = np.nonzero(which >= 0)
    j = which[i, place]
    exact = inner(queries[i], vectors[j])
    i, j, exact = _ranked(i, j, exact, low, k)
    bar = np.full(len(queries), np.inf)
    np.minimum.at(bar, i, exact)
    last = np.where((which >= 0).all(axis=1), top.min(axis=1), -np.inf)
    tied = np.flatnonzero(np.isfinite(last) & (last >= bar - 1e-9 * np.maximum(1, np.abs(bar))))
    if not len(tied):
        return i, j, exact
    rest = ~np.isin(i, tied)
    parts = [(i[rest], j[rest], exact[rest])]
    for t in tied.tolist():
        own = np.flatnonzero(np.isin(leaf, wanted[1][wanted[0] == t]))
        _, at, score = best_of(queries[t : t + 1], vectors[own], low[own], k)
        parts.append((np.full(len(at), t), own[at], score))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def shards_of(counts: list[np.ndarray]) -> tuple[list[np.ndarray], dict[tuple[int, int], int]]:
    """For each tree the shard of each leaf, by the number of vectors in it, and the parts of shards that need several."""
    shards, parts = [], {}
    for t, n in enumerate(counts):
        own, at, held = np.zeros(len(n), np.int64), 0, 0
        for leaf, size in enumerate(n.tolist()):
            if held and held + size > SHARD_ROWS:
                at, held = at + 1, 0
            own[leaf] = at
            held += size
            if held > SHARD_ROWS:
                parts[t, at] = -(-held // SHARD_ROWS)
        shards.append(own)
    return shards, parts


def usable(vectors: DataFrame, name: str = "embedding") -> DataFrame:
    """vec_id and v, single or double precision as given, of the vectors that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    single = vectors.schema[name].dataType == T.ArrayType(T.FloatType()) or vectors.schema[name].dataType == T.ArrayType(T.FloatType(), False)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(name).cast("array<float>" if single else "array<double>").alias("v")).where("vec_id is not null and v is not null")
    return rows.where(F.forall("v", finite)).where(F.exists("v", lambda x: x != 0.0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, name: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for the queries, the rows whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = checkpointed(usable(vectors, name))
    result = "query_id bigint, rank int, vec_id bigint, score double"
    width = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("v") == width.n)
    place = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    entries = rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = checkpointed(entries)
    queries = rows.where(F.col("vec_id") % every == 0)
    square = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    kind = rows.schema["v"].dataType.simpleString()
    facts = entries.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("most")).first()
    drawn = entries.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < min(1.0, 0.9 * SAMPLE / facts.n) * (1 << 30)) if facts.n > SAMPLE else entries
    sample = np.array(sorted(r.v for r in drawn.select("v").limit(SAMPLE).collect())).reshape(-1, width.n)
    forest = grown(sample, float(facts.most) ** 0.5)
    shared = spark.sparkContext.broadcast(forest)
    wanted = _reach(entries, queries, shared, forest, k)

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, BLOCK):
            leaf = shared.value.leaves(_matrix(b.column("v")))
            yield pa.RecordBatch.from_arrays([b.column("v"), b.column("ids"), pa.array(list(leaf), pa.list_(pa.int64()))], names=["v", "ids", "leaves"])

    placed = checkpointed(entries.mapInArrow(filed, f"v {kind}, ids array<bigint>, leaves array<bigint>"))
    seen = placed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()  # a row a leaf of the forest
    counts = [np.zeros(len(t.sizes), np.int64) for t in forest.trees]
    for r in seen:
        counts[r.tree][r.leaf] = r["count"]
    shards, parts = shards_of(counts)
    dealt = spark.sparkContext.broadcast((shards, parts))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, parts = dealt.value
        for b in sliced(batches, BLOCK):
            tree, shard, part, take, leaves = [], [], [], [], []
            for i, pairs in enumerate(shared.value.visited(_matrix(b.column("v")), wanted)):
                visits: dict[tuple[int, int], list[int]] = {}
                for t, n in pairs:
                    visits.setdefault((t, int(shards[t][n])), []).append(n)
                for (t, n), own in visits.items():
                    for p in range(parts.get((t, n), 1)):
                        tree.append(t)
                        shard.append(n)
                        part.append(p)
                        take.append(i)
                        leaves.append(own)
            take = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(shard, pa.int64()), pa.array(part, pa.int32()), b.column("v").take(take), b.column("vec_id").take(take), pa.array(leaves, pa.list_(pa.int64()))], names=["tree", "shard", "part", "q", "query_id", "visits"])

    going = checkpointed(queries.mapInArrow(asked, f"tree int, shard bigint, part int, q {kind}, query_id bigint, visits array<bigint>"))
    key = ["tree", "shard", "part"]
    blocks = checkpointed(going.groupBy(*key).count().select(*key, F.ceil(F.col("count") / QUERY_ROWS).cast("int").alias("blocks")))
    going = going.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks").cast("long")).cast("int")).drop("blocks")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, parts = dealt.value
        for b in sliced(batches, BLOCK):
            if not b.num_rows:
                continue
            leaf = np.array(b.column("leaves").to_pylist(), np.int64)
            first = np.array([x[0] for x in b.column("ids").to_pylist()], np.int64).view(np.uint64)
            draw = ((first ^ (first >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for t in range(leaf.shape[1]):
                own = shards[t][leaf[:, t]]
                n = np.array([parts.get((t, x), 1) for x in own.tolist()], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t), pa.int32()), pa.array(own), pa.array((draw % n).astype(np.int32)), pa.array(leaf[:, t]), b.column("v"), b.column("ids")], names=["tree", "shard", "part", "leaf", "v", "ids"])

    held = placed.mapInArrow(spread, f"tree int, shard bigint, part int, leaf bigint, v {kind}, ids array<bigint>")
    held = held.join(blocks, key).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def multiplied(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, scores, query = [], [], []
        if left.num_rows and right.num_rows:
            v, q = _matrix(left.column("v").combine_chunks()), _matrix(right.column("q").combine_chunks())
            lists, visits = left.column("ids").to_pylist(), right.column("visits").combine_chunks()
            asking = right.column("query_id").to_numpy()
            pairs = np.repeat(np.arange(len(q)), visits.value_lengths().to_numpy(zero_copy_only=False)), visits.flatten().to_numpy()
            i, j, s = best_in_leaves(q, pairs, v, left.column("leaf").to_numpy(), np.array([x[0] for x in lists]), k)
            ids, scores, query = [lists[x] for x in j.tolist()], s, asking[i]
        return pa.table({"query_id": pa.array(query, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64())), "score": pa.array(scores, pa.float64())})

    key = [*key, "block"]
    found = held.groupBy(*key).cogroup(going.groupBy(*key)).applyInArrow(multiplied, "query_id bigint, ids array<bigint>, score double")
    found = found.groupBy("query_id", "score", "ids").agg(F.count(F.lit(1)).alias("seen")).select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _reach(entries: DataFrame, queries: DataFrame, shared: Broadcast, forest: Forest, k: int) -> int:
    """The reach that the true neighbours of PROBES queries ask for; these are found by an exact scan of all entries."""
    drawn = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBES).collect()
    if not drawn:
        return 1
    names, probes = [r.vec_id for r in drawn], np.array([r.v for r in drawn], np.float64)
    held = entries.sparkSession.sparkContext.broadcast(probes)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, BLOCK):
            v, ids = _matrix(b.column("v")), b.column("ids").to_pylist()
            if not ids:
                continue
            i, j, score = best_of(held.value, v, np.array([x[0] for x in ids]), k)
            leaf = shared.value.leaves(v)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(score), pa.array([ids[x] for x in j.tolist()], pa.list_(pa.int64())), pa.array([leaf[x] for x in j.tolist()], pa.list_(pa.int64()))], names=["probe", "score", "ids", "leaves"])

    place = F.row_number().over(W.partitionBy("probe").orderBy(F.desc("score"), "ids"))
    best = entries.mapInArrow(scanned, "probe bigint, score double, ids array<bigint>, leaves array<bigint>").withColumn("place", place).where(F.col("place") <= k + 1).collect()
    truth = [np.array([r.leaves for r in sorted(best, key=lambda r: r.place) if r.probe == p and r.ids != [name]][:k], np.int64).reshape(-1, len(forest.trees)) for p, name in enumerate(names)]
    return measured_reach(forest, probes, truth)
