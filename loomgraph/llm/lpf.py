"""Cross-document removal of repeated byte strings with longest-previous-factor arrays.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a smaller doc_id.  Suffixes are
sorted, neighbours in that order have a longest common prefix, and the nearest suffix of a smaller document before or after
a suffix (the previous and the next smaller position) shares the longest earlier match with it: the larger of the two least
common prefixes on the way is its longest previous factor.  Where that reaches ``LENGTH`` bytes, so many bytes of the later
copy go, and the first stays.

One suffix array over a corpus fits no machine, so suffixes are dealt to shards that can be sorted alone:

* A window of ``LENGTH`` bytes belongs to its minimizer, the ``GRAM``-byte string in it with the least hash (the first of
  several).  Equal windows have equal minimizers, so shards by minimizer see every match.  Consecutive windows with one
  minimizer travel as one segment of 66 bytes on average.
* Minimizers that occur in one document only cannot be part of a match.  A first pass ships four bytes for each distinct
  minimizer of a chunk and gets back a bit: whether another chunk has it.  Segments of other minimizers never move.
* Equal segments are one: a chunk sends the one of its smallest document, the shard sorts the suffixes of distinct
  segments only, and the later copies of a segment are removed whole.  Segments are found equal by a hash and then
  compared byte by byte.

Texts are packed once into compressed chunks in the shared folder, bucketed by chunk, so that no later step moves them.
The result is written there too, and the chunks are removed.

Defined results: null texts are empty; texts shorter than ``LENGTH`` bytes keep all; documents with a null doc_id neither
lose bytes nor cause losses; rows with equal doc_ids do not match each other; long texts are cut into overlapping pieces.
doc_id is a whole number or null (other types are cast to long, and what is no number raises); other columns may have any
names; empty input, empty output.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm.common import discard, octets, shared_path, shuffle_width, written

LENGTH = 50
GRAM = 16
#: Bytes of text in a chunk, and of those hashed at once, which take about sixty times as much memory.
CHUNK = 2 << 20
PIECE = 1 << 19
#: Bytes of text for each task that a shard's segments come from.
SHARD_BYTES = 6 << 20
#: Windows that are sorted at once, whole minimizers at a time.
SORTED = 250_000

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out, k, p = np.ones(n, np.uint64), 1, base
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * U(p)
        k, p = 2 * k, p * p % (1 << 64)
    return out


class _Tables:
    """Powers of the base and of its inverse, as long as needed so far."""

    up = np.ones(0, np.uint64)
    down = np.ones(0, np.uint64)

    @classmethod
    def to(cls, n: int) -> None:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which hash_of() gets the hash of any string of eight bytes or more."""
    n = len(data)
    _Tables.to(n + 1)
    a = np.zeros(n + 8, np.uint64)
    a[:n] = data
    a = a[:-1] | a[1:] << U(8)
    a = a[:-2] | a[2:] << U(16)
    a = (a[:-4] | a[4:] << U(32))[:n]
    g = _mixed(a)
    g *= _Tables.up[:n]
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(g, out=out[1:])
    return out


def hash_of(total: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    return (total[start + size - 7] - total[start]) * _Tables.down[start]


def segments(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts that begin at ``starts`` (the last is the end): each segment's minimizer, begin, length, content, text.

    A segment is the bytes of consecutive windows of one text with one minimizer; content is a hash of it.
    """
    n, width = len(data), LENGTH - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none.astype(np.uint64), none, none, none.astype(np.uint64), none
    total = sums(data)
    h = _mixed((total[GRAM - 7 : n - 6] - total[: n - GRAM + 1]) * _Tables.down[: n - GRAM + 1])
    least = (h & U(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: span - width], least[width - span :])
    least = (least & U(0xFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= starts[text + 1]
    change = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(np.append(True, change | ~inside[:-1]) & inside)
    last = np.flatnonzero(np.append(change | ~inside[1:], True) & inside)
    size = last - first + LENGTH
    content = hash_of(total, first, size) * U(0x9FB21C651E98DF25) + size.astype(np.uint64)
    return h[least[first]], first, size, content, text[first]


def _pieces(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Ranges of whole texts of bounded size; a longer text by itself in pieces that share LENGTH - 1 bytes."""
    i = 0
    while i < len(starts) - 1:
        j = i + 1
        if starts[j] - starts[i] > PIECE:
            for s in range(int(starts[i]), int(starts[j]) - LENGTH + 1, PIECE):
                e = min(int(starts[j]), s + PIECE + LENGTH - 1)
                yield s, data[s:e], np.array([0, e - s]), i
        else:
            while j < len(starts) - 1 and starts[j + 1] - starts[i] <= PIECE:
                j += 1
            yield int(starts[i]), data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], i
        i = j


class Chunk:
    """A packed row: texts one after the other, with their doc_ids."""

    def __init__(self, ids: list, sizes: list, data: bytes):
        self.ids, self.raw = ids, zstandard.ZstdDecompressor().decompress(data) if data else b""
        self.data = np.frombuffer(self.raw, np.uint8)
        self.starts = np.append(0, np.cumsum(np.array(sizes, np.int64))).astype(np.int64)

    def segments(self) -> tuple[np.ndarray, ...]:
        """minimizer, begin, length, content and doc_id of the segments of documents that have a doc_id."""
        known = np.array([x is not None for x in self.ids], bool)
        named = np.array([x or 0 for x in self.ids], np.int64)
        parts = []
        for at, data, starts, text in _pieces(self.data, self.starts):
            h, first, size, content, own = segments(data, starts)
            own = own + text
            ok = known[own] if len(own) else np.zeros(0, bool)
            parts.append((h[ok], first[ok] + at, size[ok], content[ok], named[own[ok]]))
        if not parts:
            return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 2, np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _names(h: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits of a minimizer's hash: ``bits`` of them choose the shard, 32 more tell it from others there."""
    return h >> U(32 - bits)


def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer, part, count = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), 0
    ids, sizes, texts, held = [], [], [], 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part << 32 | count], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([packer.compress(b"".join(texts))], pa.binary())], names=["chunk", "ids", "sizes", "data"])

    for b in batches:
        for doc_id, text in zip(b.column("doc_id").to_pylist(), octets(b.column("text")), strict=True):
            text = text or b""
            if ids and held + len(text) > CHUNK:
                yield row()
                count += 1
                ids, sizes, texts, held = [], [], [], 0
            ids.append(doc_id)
            sizes.append(len(text))
            texts.append(text)
            held += len(text)
    if ids:
        yield row()


def packed(docs: DataFrame) -> tuple[str, str, int]:
    """The name and folder of a bucketed table with chunks of texts, and the bytes of all texts."""
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = narrow.mapInArrow(_packing, "chunk bigint, ids array<bigint>, sizes array<bigint>, data binary")
    name = f"loomgraph_chunks_{uuid.uuid4().hex}"
    buckets = max(shuffle_width(spark), 1)
    path = shared_path(spark, "chunks")
    chunks.write.format("parquet").option("compression", "none").option("parquet.block.size", 8 << 20).option("path", path).bucketBy(buckets, "chunk").saveAsTable(name)
    total = spark.table(name).select(F.explode("sizes").alias("n")).agg(F.sum("n")).first()[0]
    return name, path, int(total or 0)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, Chunk]]:
    for i in range(batch.num_rows):
        yield batch.column("chunk")[i].as_py(), Chunk(batch.column("ids")[i].as_py(), batch.column("sizes")[i].as_py(), batch.column("data")[i].as_py())


def _rows(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


_SHIPPED = [("bucket", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary())]
_SHIPPED_DDL = "bucket bigint, chunk bigint, data binary"


def _by_bucket(names: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Bucket, begin and end of its stretch of sorted names."""
    bucket = (names >> U(32)).astype(np.int64)
    first, last = _stretches(bucket)
    yield from zip(bucket[first].tolist(), first.tolist(), last.tolist(), strict=True)


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of equal values; none of no values."""
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return first, np.append(first, len(values))[1:]


def _minimizers(bits: int):
    """Each chunk's distinct minimizers by bucket."""

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, held in _chunks(b):
                names = np.unique(_names(held.segments()[0], bits))
                yield _rows([(k, chunk, names[s:e].astype(np.uint32).tobytes()) for k, s, e in _by_bucket(names)], _SHIPPED)

    return ship


def _shared_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each shipment a bit per minimizer: whether another chunk has it."""
    keys, rows = [np.zeros(0, np.uint64)], []
    for b in batches:
        for bucket, chunk, data in zip(b.column("bucket").to_pylist(), b.column("chunk").to_pylist(), b.column("data").to_pylist(), strict=True):
            names = np.frombuffer(data, np.uint32).astype(np.uint64) | U(bucket << 32)
            keys.append(names)
            rows.append((bucket, chunk, len(names)))
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    twice = np.zeros(len(every), bool)
    same = every[1:] == every[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    answer = np.empty(len(every), bool)
    answer[order] = twice
    at = 0
    for i in range(0, len(rows), 256):
        out = []
        for bucket, chunk, n in rows[i : i + 256]:
            out.append((bucket, chunk, np.packbits(answer[at : at + n]).tobytes()))
            at += n
        yield _rows(out, _SHIPPED)


def _cover(start: np.ndarray, size: np.ndarray) -> bytes:
    return start.astype(np.uint32).tobytes() + size.astype(np.uint8).tobytes()


def _uncover(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 5
    return np.frombuffer(data, np.uint32, n).astype(np.int64), np.frombuffer(data, np.uint8, n, 4 * n).astype(np.int64)


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of many short stretches, one after the other."""
    ends = np.cumsum(size)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)]


_LOCAL = -1


def _wide(data: np.ndarray, width: int) -> np.ndarray:
    """For every place the ``width`` bytes from there on; zeros follow the end."""
    return np.lib.stride_tricks.as_strided(np.append(data, np.zeros(width, np.uint8)), (len(data) + 1, width), (1, 1))


def kinds(names: np.ndarray, content: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of segments by minimizer, content and document, and where in it a content begins.

    Segments of one minimizer whose contents' hashes are equal count as equal once their bytes are; those that differ from
    the first of them in spite of the hash get another one.
    """
    wide = _wide(data, int(size.max())) if len(size) else None
    while True:
        order = np.lexsort((start, doc, content, names))
        a, b = names[order], content[order]
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        lead = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(a) else order
        wrong = size[order] != size[lead]
        check = np.flatnonzero(~fresh & ~wrong)
        for i in range(0, len(check), 1 << 16):
            k = check[i : i + (1 << 16)]
            x, y = order[k], lead[k]
            inside = np.arange(wide.shape[1]) < size[x][:, None]
            wrong[k] = ((wide[at[x]] != wide[at[y]]) & inside).any(axis=1)
        if not wrong.any():
            return order, fresh
        content = content.copy()
        content[order[wrong]] += U(1)


def _segments(bits: int):
    """The segments whose minimizers another document has, by bucket; what the chunk itself can remove goes to bucket -1."""

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for b in batches:
            answers = b.column("bits")
            for i, (chunk, held) in enumerate(_chunks(b)):
                h, start, size, content, doc = held.segments()
                names = _names(h, bits)
                order = np.argsort(names, kind="stable")
                names, start, size, content, doc = (x[order] for x in (names, start, size, content, doc))
                head = np.append(True, names[1:] != names[:-1])[: len(names)]
                group = np.cumsum(head) - 1
                distinct = names[head]
                known = np.zeros(len(distinct), bool)
                told = {k: v for k, v in ((x["bucket"], x["data"]) for x in (answers[i].as_py() or []))}
                for k, s, e in _by_bucket(distinct):
                    known[s:e] = np.unpackbits(np.frombuffer(told[k], np.uint8), count=e - s).astype(bool)
                if len(doc):
                    first = np.flatnonzero(head)
                    known |= np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                keep = known[group]
                names, start, size, content, doc = (x[keep] for x in (names, start, size, content, doc))
                order, fresh = kinds(names, content, doc, start, size, held.data, start)
                names, start, size, doc = (x[order] for x in (names, start, size, doc))
                lowest = doc[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(doc) else doc
                later = doc > lowest
                rows = [(_LOCAL - chunk % 4096, chunk, _cover(start[later], size[later]))] if later.any() else []
                names, start, size, doc = (x[~later] for x in (names, start, size, doc))
                for k, s, e in _by_bucket(names):
                    z = size[s:e]
                    body = names[s:e].astype(np.uint32).tobytes() + doc[s:e].tobytes() + start[s:e].astype(np.uint32).tobytes() + z.astype(np.uint8).tobytes() + _gathered(held.data, start[s:e], z).tobytes()
                    rows.append((k, chunk, (e - s).to_bytes(4, "little") + packer.compress(body)))
                for s in range(0, len(rows), 128):
                    yield _rows(rows[s : s + 128], _SHIPPED)

    return ship


def earlier_windows(data: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every window of the given stretches, its longest previous factor within its stretch, 0 below LENGTH."""
    n = size - LENGTH + 1
    owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at, rest = offset + start[owner], size[owner] - offset
    out = np.zeros(len(owner), np.int64)
    parts = -(-len(owner) // SORTED)
    if parts < 2:
        out[:] = previous_factors(data, at, rest, doc[owner], LENGTH)
        return out
    # too many for one array: windows with a match of LENGTH bytes agree in three of their words, so shares by these words
    # hold all such matches
    words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    share = np.zeros(len(owner), np.uint64)
    for k in (0, 21, LENGTH - 8):
        share = _mixed(share ^ np.ascontiguousarray(words[at + k]).view(np.uint64).ravel())
    share = (share % U(parts)).astype(np.int32)
    for k in range(parts):
        mine = np.flatnonzero(share == k)
        out[mine] = previous_factors(data, at[mine], rest[mine], doc[owner[mine]], LENGTH)
    return out


def previous_factors(data: np.ndarray, at: np.ndarray, rest: np.ndarray, doc: np.ndarray, floor: int = 1) -> np.ndarray:
    """Of suffixes with ``rest`` bytes from ``at`` on, the longest prefix that a suffix of a smaller document shares.

    Values below ``floor`` are given as 0.
    """
    out = np.zeros(len(at), np.int64)
    if not len(at):
        return out
    by_doc = np.lexsort((doc, rest))  # of suffixes alike but for zeros at the end, the shorter comes first
    width = int(rest.max())
    rows = _wide(data, width)[at[by_doc]]
    rows[np.arange(width) >= rest[by_doc][:, None]] = 0
    order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
    suffix_array, rows = by_doc[order], rows[order]
    own, left = doc[suffix_array], rest[suffix_array]
    common = np.zeros(len(at), np.int64)
    for i in range(1, len(at), 1 << 16):
        apart = rows[i : i + (1 << 16)] != rows[i - 1 : i - 1 + len(rows[i : i + (1 << 16)])]
        common[i : i + (1 << 16)] = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    common[1:] = np.minimum(common[1:], np.minimum(left[1:], left[:-1]))
    after = smaller_before(own[::-1], np.append(0, common[1:][::-1]), floor)[::-1]
    out[suffix_array] = np.maximum(smaller_before(own, common, floor), after)
    return out


def smaller_before(own: np.ndarray, common: np.ndarray, floor: int) -> np.ndarray:
    """For each place the least ``common`` on the way to the nearest place before it with a smaller ``own``; 0 below floor.

    common: of each place and the one before it.  All places look one step back; those that find nothing smaller take over
    how far the place they looked at has looked, so that steps double.
    """
    before, least = np.arange(len(own)) - 1, common.copy()
    out = np.zeros(len(own), np.int64)
    open_ = np.flatnonzero(least >= floor)
    while len(open_):
        there = before[open_]
        done = own[there] < own[open_]
        out[open_[done]] = least[open_[done]]
        open_, there = open_[~done], there[~done]
        least[open_], before[open_] = np.minimum(least[open_], least[there]), before[there]
        open_ = open_[least[open_] >= floor]
    return out


def _runs(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the runs of set flags within one owner."""
    apart = owner[1:] != owner[:-1]
    first = np.flatnonzero(flags & np.append(True, ~flags[:-1] | apart)[: len(flags)])
    last = np.flatnonzero(flags & np.append(~flags[1:] | apart, True)[: len(flags)])
    return first, last


def contents(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of segments, as segments() gives them."""
    if not len(at):
        return np.zeros(0, np.uint64)
    return hash_of(sums(data), at, size) * U(0x9FB21C651E98DF25) + size.astype(np.uint64)


def covered(names: np.ndarray, content: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a shard's segments: the row, begin and length of the stretches to remove.  at: where a segment's bytes are."""
    order, fresh = kinds(names, content, doc, start, size, data, at)
    own = doc[order]
    kind = np.cumsum(fresh) - 1
    lead = order[np.flatnonzero(fresh)]
    whole = own > doc[lead][kind] if len(kind) else np.zeros(0, bool)
    rows, begin, length = [order[whole]], [start[order[whole]]], [size[order[whole]]]
    # distinct segments whose minimizer other distinct segments have: only they can hold further matches
    of = names[lead]
    head = np.append(True, of[1:] != of[:-1])[: len(of)]
    group = np.cumsum(head) - 1
    several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    mixed = np.flatnonzero(several)
    first_of = np.zeros(len(lead) + 1, np.int64)
    first_of[1:] = np.cumsum(np.bincount(kind, minlength=len(lead))) if len(kind) else 0
    windows = np.cumsum(size[lead[mixed]] - LENGTH + 1)
    s = 0
    while s < len(mixed):
        e = int(np.searchsorted(windows, (windows[s - 1] if s else 0) + SORTED, "right"))
        e = max(e, s + 1)
        while e < len(mixed) and group[mixed[e]] == group[mixed[e - 1]]:
            e += 1
        part = mixed[s:e]
        seg = lead[part]
        n = size[seg] - LENGTH + 1
        owner = np.repeat(np.arange(len(seg)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        factor = earlier_windows(data, at[seg], size[seg], doc[seg])
        first, last = _runs(factor > 0, owner)
        reach = np.maximum.reduceat(np.append(offset + factor, 0), np.stack([first, last + 1], 1).ravel())[::2] if len(first) else first
        # the same flags hold for every segment of that content in the leading document
        for a, b in _shares(part, first_of, owner[first]):
            rec = order[b]
            mine = doc[rec] == doc[lead[part[owner[first[a]]]]]
            a, rec = a[mine], rec[mine]
            rows.append(rec)
            begin.append(start[rec] + offset[first[a]])
            length.append(reach[a] - offset[first[a]])
        s = e
    return np.concatenate(rows), np.concatenate(begin), np.concatenate(length)


def _shares(part: np.ndarray, first_of: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a run and an index of a segment (in sorted order) that has the content the run was found in."""
    if not len(owner):
        return
    low, high = first_of[part[owner]], first_of[part[owner] + 1]
    n = high - low
    run = np.repeat(np.arange(len(owner)), n)
    yield run, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


_COVERS = [("chunk", pa.int64()), ("data", pa.binary())]


def _removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's stretches to remove, by chunk; what a chunk has settled itself passes through."""
    unpack = zstandard.ZstdDecompressor()
    names, content, doc, start, size, data, chunk = [], [], [], [], [], [], []
    for b in batches:
        passed = []
        for bucket, c, raw in zip(b.column("bucket").to_pylist(), b.column("chunk").to_pylist(), b.column("data").to_pylist(), strict=True):
            if bucket < 0:
                passed.append((c, raw))
                continue
            n, body = int.from_bytes(raw[:4], "little"), unpack.decompress(raw[4:])
            names.append(np.frombuffer(body, np.uint32, n).astype(np.uint64) | U(bucket << 32))
            doc.append(np.frombuffer(body, np.int64, n, 4 * n))
            start.append(np.frombuffer(body, np.uint32, n, 12 * n).astype(np.int64))
            size.append(np.frombuffer(body, np.uint8, n, 16 * n).astype(np.int64))
            data.append(np.frombuffer(body, np.uint8, -1, 17 * n))
            content.append(contents(data[-1], np.cumsum(size[-1]) - size[-1], size[-1]))
            chunk.append(np.full(n, c))
        if passed:
            yield _rows(passed, _COVERS)
    if not names:
        return
    size, chunk, start, data = np.concatenate(size), np.concatenate(chunk), np.concatenate(start), np.concatenate(data)
    names, content, doc = np.concatenate(names), np.concatenate(content), np.concatenate(doc)
    rows, begin, length = covered(names, content, doc, start, size, data, np.cumsum(size) - size)
    order = np.argsort(chunk[rows], kind="stable")
    own, begin, length = chunk[rows][order], begin[order], length[order]
    out = [(int(own[s]), _cover(begin[s:e], length[s:e])) for s, e in zip(*(x.tolist() for x in _stretches(own)), strict=True)]
    for i in range(0, len(out), 256):
        yield _rows(out[i : i + 256], _COVERS)


def _applied(kept_text: bool):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            covers = b.column("covers")
            for i, (_, held) in enumerate(_chunks(b)):
                edge = np.zeros(len(held.data) + 1, np.int32)
                for raw in covers[i].as_py() or []:
                    s, n = _uncover(raw)
                    np.add.at(edge, s, 1)
                    np.add.at(edge, s + n, -1)
                gone = np.cumsum(edge, dtype=np.int32)[:-1] > 0
                rows = []
                for k, doc_id in enumerate(held.ids):
                    s, e = int(held.starts[k]), int(held.starts[k + 1])
                    mine = gone[s:e]
                    removed = int(mine.sum())
                    kept = held.raw[s:e] if not removed else held.data[s:e][~mine].tobytes()
                    spans = int(mine[0]) + int((mine[1:] & ~mine[:-1]).sum()) if removed else 0
                    rows.append((doc_id, e - s, removed, spans, hashlib.sha256(kept).hexdigest(), *([kept] if kept_text else [])))
                yield _rows(rows, [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *([("kept", pa.binary())] if kept_text else [])])

    return apply


def deduplicated(docs: DataFrame, kept_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and on demand the remaining bytes themselves as ``kept``."""
    spark: SparkSession = docs.sparkSession
    name, path, total = packed(docs)
    try:
        chunks = spark.table(name)
        tasks = max(shuffle_width(spark), math.ceil(total / SHARD_BYTES))
        bits = max(8, math.ceil(math.log2(4 * tasks)))
        minimizers = chunks.mapInArrow(_minimizers(bits), _SHIPPED_DDL)
        told = minimizers.repartition(tasks, "bucket").mapInArrow(_shared_bits, _SHIPPED_DDL)
        told = told.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "data")).alias("bits"))
        shipped = chunks.join(told.hint("shuffle_hash"), "chunk", "left").mapInArrow(_segments(bits), _SHIPPED_DDL)
        covers = shipped.repartition(tasks, "bucket").mapInArrow(_removals, "chunk bigint, data binary")
        covers = covers.groupBy("chunk").agg(F.collect_list("data").alias("covers"))
        ddl = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * kept_text
        return written(chunks.join(covers.hint("shuffle_hash"), "chunk", "left").mapInArrow(_applied(kept_text), ddl), "kept")[0]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(spark, path)
