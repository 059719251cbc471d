"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint is the bitwise majority of the XXH64 hashes of a document's word shingles.  Its 64 bits are cut into
segments of 23, 23 and 18 bits.  Of at most four differing bits the segment with the most holds so many that the other
two hold at most two together (pigeonhole), so every link shows in one of the three pairs of segments.  The perfect
binary Golay code assigns each 23-bit word to one codeword index of 12 bits; a pair of segments gets as keys the index
pairs of itself and of every word at distance one.  Two pairs at distance two have such a word in common, at distance one
each has the other's: they share a key.  That is about ten 24-bit keys a pair, since most flips keep the codeword.

Fingerprints that are equal are one node, so copies cost nothing.  Keys are dealt over tasks; a task sorts its keys and
verifies candidates by exact Hamming distance.  Large buckets are searched breadth first against the fingerprints that
are not yet reached, so dense groups cost a few passes, not all pairs.  Each task hands on a spanning forest only.

Defined results: null and empty texts have fingerprint zero, as documents without words; null doc_ids count last, so a
component's id is null only if all its doc_ids are; repeated rows are copies of each other; empty input, empty output.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import BROADCAST_ROWS, checkpointed, fresh_name, octets, shuffle_width, sliced, with_facts
from loomgraph.llm.components import components, spanning

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0xAE3
#: Rows of keys that a task should get.
KEYS_A_TASK = 1_000_000
KEYS_EACH = 32
SMALL_BUCKET = 16
STEP = 200_000


def shingle_hashes(text: bytes, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, in pieces.  lower() and split() of bytes touch A-Z and the six ASCII white spaces only."""
    words = text.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    take = max(1, len(words) - width + 1)
    starts, ends = starts[:take].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for i in range(0, take, STEP):
        yield np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i : i + STEP], ends[i : i + STEP], strict=True)], np.uint64)


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text or b"", width):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]) if n else 0


def _parities() -> np.ndarray:
    """Remainder by the generator of each 12-bit message shifted by 11."""
    out = np.zeros(4096, np.int64)
    for m in range(4096):
        r = m << 11
        for bit in range(22, 10, -1):
            if r >> bit & 1:
                r ^= GOLAY << (bit - 11)
        out[m] = r
    return out


def _errors(parity: np.ndarray) -> np.ndarray:
    """The error pattern of at most three bits for each of the 2048 syndromes; the code is perfect, so each has one."""
    one = [1 << i for i in range(23)]
    patterns = [0, *one, *(a | b for i, a in enumerate(one) for b in one[:i])]
    patterns += [a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]]
    x = np.array(patterns)
    table = np.zeros(2048, np.int64)
    table[parity[x >> 11] ^ (x & 2047)] = x
    return table


_PARITY = _parities()
_ERROR = _errors(_PARITY)


def decode(x: np.ndarray) -> np.ndarray:
    """Index of the codeword within three bits of each 23-bit word."""
    return (x ^ _ERROR[_PARITY[x >> 11] ^ (x & 2047)]) >> 11


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and the row of the fingerprint that each belongs to, without repeats in a row."""
    own, flipped = [], []
    for low, width in SEGMENTS:
        x = ((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
        own.append(decode(x))
        flipped.append(decode(x[:, None] ^ (1 << np.arange(width))))
    columns = []
    for k, (a, b) in enumerate(PAIRS):
        tag = k << 24
        columns += [(tag | own[a] << 12 | own[b])[:, None], tag | flipped[a] << 12 | own[b][:, None], tag | (own[a] << 12)[:, None] | flipped[b]]
    keys = np.sort(np.concatenate(columns, axis=1), axis=1)
    fresh = np.ones(keys.shape, bool)
    fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
    rows, _ = np.nonzero(fresh)
    return keys[fresh].astype(np.int32), rows


def _reached(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of one bucket, breadth first against what is left."""
    left = prints
    while len(left) > 1:
        seed, left = left[0], left[1:]
        frontier = np.array([seed], np.uint64)
        while len(frontier) and len(left):
            now, frontier = frontier[:64], frontier[64:]
            near = (np.bitwise_count(left[:, None] ^ now[None, :]) <= DISTANCE).any(axis=1)
            if near.any():
                got = left[near]
                yield got, np.full(len(got), seed, np.uint64)
                frontier, left = np.append(frontier, got), left[~near]


def links_of(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the verified links among fingerprints that share a key here."""
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(keys)))
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    small = np.repeat(size <= SMALL_BUCKET, size)
    k, p = keys[small], prints[small]
    for off in range(1, min(SMALL_BUCKET, len(k))):
        near = np.flatnonzero(k[off:] == k[:-off])
        if not len(near):
            break
        near = near[np.bitwise_count(p[near + off] ^ p[near]) <= DISTANCE]
        a.append(p[near + off])
        b.append(p[near])
    for i in np.flatnonzero(size > SMALL_BUCKET):
        for x, y in _reached(np.unique(prints[first[i] : first[i] + size[i]])):
            a.append(x)
            b.append(y)
    return spanning(np.concatenate(a), np.concatenate(b))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        prints = np.array([fingerprint(t) for t in octets(b.column("text"))], np.uint64).view(np.int64)
        keep = [i for i, name in enumerate(b.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(prints)], names=[*(b.schema.names[i] for i in keep), "fp"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        prints = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        keys, rows = golay_keys(prints)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows].view(np.int64))], names=["key", "fp"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, prints = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for b in sliced(batches):
        keys.append(b.column("key").to_numpy(zero_copy_only=False))
        prints.append(b.column("fp").to_numpy(zero_copy_only=False))
    u, v = links_of(np.concatenate(keys), np.concatenate(prints).view(np.uint64))
    for i in range(0, len(u), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(u[i : i + 100_000].view(np.int64)), pa.array(v[i : i + 100_000].view(np.int64))], names=["u", "v"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with their texts replaced by the fingerprint ``fp`` (the 64 bits as a signed long)."""
    fields = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(_fingerprints, T.StructType([*fields, T.StructField("fp", T.LongType())]))


def print_components(prints: DataFrame) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``prints`` that is linked and is not its component's root."""
    spark = prints.sparkSession
    distinct = prints.select("fp").distinct()
    n = distinct.count()
    tasks = max(shuffle_width(spark), math.ceil(n * KEYS_EACH / KEYS_A_TASK))
    keyed = distinct.mapInArrow(_keyed, "key int, fp bigint")
    links = keyed.repartition(tasks, "key").mapInArrow(_linked, "u bigint, v bigint")
    return components(links).withColumnRenamed("u", "fp")


def _rooted(prints: DataFrame, what: Column, name: str) -> DataFrame:
    """fp, root, n (rows) and the least ``what`` of each distinct fingerprint."""
    per = prints.groupBy("fp").agg(F.min(what).alias(name), F.count(F.lit(1)).alias("n"))
    return checkpointed(per.join(print_components(per), "fp", "left").select("fp", name, "n", F.coalesce("root", "fp").alias("root")))


def _of_component(rooted: DataFrame, name: str, least: str) -> DataFrame:
    """rooted with ``least``, the least ``name`` of its component; a component may hold any share of the fingerprints."""
    best = rooted.groupBy(F.col("root").alias("of_root")).agg(F.min(name).alias(least), F.count(F.lit(1)).alias("m")).where("m > 1")
    return with_facts(rooted, best, "root", "of_root", "m", "left").withColumn(least, F.coalesce(least, name))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id; one row per row of docs.

    Only what is not alone is joined: components of several fingerprints, and fingerprints of several rows.
    """
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    prints = checkpointed(fingerprints(narrow))
    of = _of_component(_rooted(prints, F.col("doc_id"), "low"), "low", "component_id")
    of = of.where((F.col("n") > 1) | ~F.col("component_id").eqNullSafe(F.col("low"))).select(F.col("fp").alias("of_fp"), "component_id", "n")
    return with_facts(prints, of, "fp", "of_fp", "n", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest doc_id (nulls last).

    Rows are known by doc_id and a hash of their text; of rows alike in both one stays.  Only the rows that go are worked
    out and taken away from docs, by a broadcast where they are few; other columns of docs may have any names.
    """
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row_key", F.xxhash64("doc_id", "text"))
    prints = checkpointed(fingerprints(narrow))
    pick = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row_key").alias("row_key"))
    rooted = _of_component(_rooted(prints, pick, "pick"), "pick", "best")
    grouped = rooted.where((F.col("n") > 1) | (F.col("pick") != F.col("best"))).select(F.col("fp").alias("of_fp"), F.col("best.doc_id").alias("best_id"), F.col("best.row_key").alias("best_key"), "n")
    rows = with_facts(prints, grouped, "fp", "of_fp", "n")
    mine, its, id_name, key_name = F.col("row_key"), F.col("best_key"), fresh_name(docs, "gone_id"), fresh_name(docs, "gone_key")
    gone = checkpointed(rows.where(~(F.col("doc_id").eqNullSafe(F.col("best_id")) & (mine == its))).select(F.col("doc_id").alias(id_name), mine.alias(key_name)).distinct())
    alike = rows.where(F.col("doc_id").eqNullSafe(F.col("best_id")) & (mine == its)).groupBy("doc_id", "row_key").count().where("count > 1")
    alike = checkpointed(alike.select(F.col("doc_id").alias(id_name), mine.alias(key_name)))
    key = F.xxhash64(F.col("doc_id"), F.col("text").cast("string"))

    def among(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        some = F.broadcast(some) if some.count() <= BROADCAST_ROWS else some.hint("shuffle_hash")
        return rows.join(some, F.col("doc_id").eqNullSafe(F.col(id_name)) & (key == F.col(key_name)), how)

    out = among(docs, gone, "left_anti")
    if alike.isEmpty():
        return out
    once = among(out, alike, "left_semi").withColumn(key_name, key).dropDuplicates(["doc_id", key_name]).drop(key_name)
    return among(out, alike, "left_anti").unionByName(once)
