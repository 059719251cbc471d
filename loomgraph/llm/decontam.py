"""Benchmark decontamination with suffix arrays over the training text.

Words are the runs of ASCII letters and digits and of all non-ASCII characters, with A-Z lowered.  Documents are split
into shards of bounded size; within a shard every position that could start a window (thirteen words, all of them known
to the benchmark) enters a suffix array ordered by its thirteen words, and every suffix of the benchmark is looked up in
it by binary search.  Equal ranges give the verbatim matches; matches that follow each other in one item give the longest
ones.  A window that many items have is one suffix with a list of places, so text that items share costs a position of a
document one match, not one for each item.  Documents never leave their task, so nothing is shuffled; only the benchmark
travels.

The benchmark is broadcast in blocks of at most ``BLOCK_BYTES``; a larger one is handled by as many passes over the
documents, whose hits are then united per document.  Blocks of a benchmark that fits one need no shuffle.  The driver
holds two blocks at most; broadcasts wait on its disk.

Defined results: null text has no words and no hits; a document without words is not contaminated; items without words
are no windows; a null item_id counts as the item 'null'; repeated items count once; repeated documents are judged alike,
whatever their doc_ids; texts are whole, however long; other columns may have any names; empty tables give no rows or hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import BROADCAST_ROWS, checkpointed, chunks, fresh_name, octets, sliced

WINDOW = 13
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 4 << 20
#: One hit word in so many words, or more, makes a document contaminated.
SHARE = 20
#: Places of windows that a task keeps to follow matches.
CHAIN_ROWS = 2_000_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Probe:
    """Every distinct suffix of the benchmark items, cut at thirteen words, with words as numbers (0: end of the item).

    ``places(w)``: where it begins in the concatenated items, which are a window apart; ``owners(w)``: the items that have it.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.names: list[str] = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        flat, place, length, owner, n = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for name, text in dict.fromkeys(items):
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)], np.uint32)
            if not len(ids):
                continue
            span = min(window, len(ids))
            place.append(n + np.arange(len(ids) - span + 1))
            length.append(np.full(len(place[-1]), span))
            owner.append(np.full(len(place[-1]), number[name]))
            flat += [ids, np.zeros(window, np.uint32)]
            n += len(ids) + window
        place, length, owner, words = (np.concatenate(x) for x in (place, length, owner, flat))
        rows = np.lib.stride_tricks.sliding_window_view(words, window)[place] if len(place) else np.zeros((0, window), np.uint32)
        _, first, kind = np.unique(_keys(rows), return_index=True, return_inverse=True)
        self.suffixes, self.lengths = rows[first], length[first]
        order = np.lexsort((place, kind))
        self._place, self._at = place[order], np.searchsorted(kind[order], np.arange(len(first) + 1))
        pairs = np.unique(np.stack([kind, owner], 1), axis=0)
        self._owner, self._own = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))

    def places(self, w: int) -> np.ndarray:
        return self._place[self._at[w] : self._at[w + 1]]

    def owners(self, windows: np.ndarray) -> np.ndarray:
        """The items that have any of the windows, by number."""
        if len(windows) == 1:
            return self._owner[self._own[windows[0]] : self._own[windows[0] + 1]]
        seen = np.zeros(len(self.names), bool)
        for w in windows.tolist():
            seen[self._owner[self._own[w] : self._own[w + 1]]] = True
        return np.flatnonzero(seen)


class Chains:
    """Lengths of matches that go on from window to window.

    A state is the places of a window with the number of windows that led there within one item.  States that follow from a
    state and a window are kept, so that text which many documents share is followed once; kept ones are bounded in size.
    """

    def __init__(self, probe: Probe, limit: int = CHAIN_ROWS):
        self.probe, self.limit = probe, limit
        self.after: dict[tuple[int, int], int] = {}
        self.states: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        self.held = self.number = 0

    def _next(self, state: int, w: int) -> int:
        key = (state, w)
        if key not in self.after:
            place, run = self.probe.places(w), None
            before = self.states.get(state)
            run = np.ones(len(place), np.int64)
            if before is not None:
                at = np.minimum(np.searchsorted(before[0], place - 1), len(before[0]) - 1)
                same = before[0][at] == place - 1
                run[same] += before[1][at[same]]
            if self.held > self.limit:
                self.after.clear()
                self.states.clear()
                self.held = 0
            self.number += 1
            self.after[key], self.states[self.number] = self.number, (place, run, int(run.max()))
            self.held += len(place) + 16
        return self.after[key]

    def longest(self, at: np.ndarray, windows: np.ndarray) -> int:
        """Words of the longest verbatim match of a document with one item; at: where in the document windows begin."""
        if not len(at):
            return 0
        whole = self.probe.lengths[windows] == self.probe.window
        best = int(self.probe.lengths[windows].max())
        order = np.argsort(at[whole], kind="stable")
        state, last = 0, -2
        for p, w in zip(at[whole][order].tolist(), windows[whole][order].tolist(), strict=True):
            state = self._next(state if p == last + 1 else 0, w)
            best, last = max(best, self.states[state][2] + self.probe.window - 1), p
        return best


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings in the same order (big-endian)."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


def search(ids: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ids and distinct suffixes of the benchmark that match there over the suffix's whole window.

    ids: numbers of words, 0 for words that no item has, which also end documents; padded with a window of zeros.
    """
    found_at, found = [], []
    for span in np.unique(probe.lengths):
        known = ids != 0
        bad = np.concatenate(([0], np.cumsum(~known)))
        n = len(ids) - probe.window
        starts = np.flatnonzero(bad[span : span + n] == bad[:n]) if n > 0 else np.zeros(0, np.int64)
        if not len(starts):
            continue
        order = _keys(ids[starts[:, None] + np.arange(span)])
        suffix_array = np.argsort(order, kind="stable")
        order = order[suffix_array]
        tests = np.flatnonzero(probe.lengths == span)
        wanted = _keys(probe.suffixes[tests, :span])
        low, high = np.searchsorted(order, wanted, "left"), np.searchsorted(order, wanted, "right")
        count = high - low
        hit = np.repeat(np.arange(len(tests)), count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found_at.append(starts[suffix_array[low[hit] + within]])
        found.append(tests[hit])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found)


def _intervals(at: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(at, kind="stable")
    out: list[list[int]] = []
    for s, e in zip(at[order].tolist(), (at + length)[order].tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def scan_texts(texts: list[bytes | None], probe: Probe, follow: Chains | None = None) -> Iterator[tuple[int, list[tuple[int, int]], list[str], int]]:
    """For each text: its number of words, the hit intervals, the items found and the longest match."""
    known, follow = probe.vocab, follow or Chains(probe)
    nobody = (0, [], [], 0)
    for a, b in chunks(texts, lambda t: len(t or b""), SHARD_BYTES):
        tokens: list[bytes] = []
        ends = []
        for t in texts[a:b]:
            if t:
                tokens += words_of(t)
            ends.append(len(tokens))
            tokens.append(b"")
        ids = np.zeros(len(tokens) + probe.window, np.uint32)
        ids[: len(tokens)] = np.fromiter((known.get(w, 0) for w in tokens), np.uint32, len(tokens)) if known else 0
        ends = np.array(ends)
        begins = np.append(0, ends[:-1] + 1)
        counts = ends - begins
        at, suffix = search(ids, probe)
        doc = np.searchsorted(begins, at, "right") - 1
        order = np.argsort(doc, kind="stable")
        at, suffix, doc = at[order], suffix[order], doc[order]
        cut = np.searchsorted(doc, np.arange(b - a + 1))
        for i in range(b - a):
            if cut[i] == cut[i + 1]:
                yield (int(counts[i]), *nobody[1:])
                continue
            p, q = at[cut[i] : cut[i + 1]] - begins[i], suffix[cut[i] : cut[i + 1]]
            yield int(counts[i]), _intervals(p, probe.lengths[q]), [probe.names[k] for k in probe.owners(np.unique(q)).tolist()], follow.longest(p, q)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of bounded bytes, streamed so that the driver never holds more than one."""
    held, size = [], 0
    for r in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").toLocalIterator():
        text = r.text.encode()
        if held and size + len(text) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((r.item, text))
        size += len(text)
    yield held


_RAW = "n_words bigint, hits array<struct<s:bigint,e:bigint>>, items array<string>, longest bigint"


def _raw(docs: DataFrame, probe: Probe) -> DataFrame:
    """docs' rows with the raw finding for one block of the benchmark; the text itself goes."""
    shared = docs.sparkSession.sparkContext.broadcast(probe)
    hit_type = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = shared.value
        follow = Chains(probe)
        for b in sliced(batches):
            n, hits, items, longest = zip(*scan_texts(octets(b.column("text")), probe, follow), strict=True) if b.num_rows else ((), (), (), ())
            keep = [i for i, name in enumerate(b.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in keep), pa.array(n, pa.int64()), pa.array([[{"s": s, "e": e} for s, e in h] for h in hits], hit_type), pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int64())],
                names=[*(b.schema.names[i] for i in keep), "n_words", "hits", "items", "longest"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(scan, f"{kept}, {_RAW}")


def _united(intervals: list) -> list[tuple[int, int]]:
    pairs = np.array([(r["s"], r["e"]) for r in intervals], np.int64).reshape(-1, 2)
    return _intervals(pairs[:, 0], pairs[:, 1] - pairs[:, 0])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans ("start:end" in words), longest_match."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    blocks = _blocks(benchmark)
    block, ahead = next(blocks), next(blocks, None)
    if ahead is None:
        raw = _raw(narrow, Probe(block))
    else:
        narrow = narrow.withColumn("row_key", F.xxhash64("doc_id", "text"))
        parts, n = _raw(narrow, Probe(block)), 1
        while ahead is not None:
            parts, n, ahead = parts.unionByName(_raw(narrow, Probe(ahead))), n + 1, next(blocks, None)
        # A document's rows are alike in every pass; n copies of it give n rows a pass, so one n-th of them is a copy.
        raw = (
            parts.groupBy("doc_id", "row_key")
            .agg(F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_set("hits"))).alias("hits"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), F.max("longest").alias("longest"), (F.count(F.lit(1)) / n).cast("int").alias("copies"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            spans = [_united(h or []) for h in b.column("hits").to_pylist()]
            items = [sorted(x or []) for x in b.column("items").to_pylist()]
            words = b.column("n_words").to_pylist()
            hit = [sum(e - s for s, e in x) for x in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    b.column("n_words"),
                    pa.array(hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                    pa.array([h > 0 and SHARE * h >= n for h, n in zip(hit, words, strict=True)], pa.bool_()),
                    pa.array([",".join(f"{s}:{e}" for s, e in x) for x in spans], pa.string()),
                    b.column("longest"),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans", "longest_match"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return raw.select("doc_id", "n_words", "hits", "items", "longest").mapInArrow(digest, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, hit_spans string, longest_match bigint")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns; one narrow pass for each block of the benchmark.

    Rows are judged by their own text, whatever their doc_id: over several blocks by its SHA-256.
    """
    blocks = _blocks(benchmark)
    block = next(blocks)
    if next(blocks, None) is not None:
        key, name = F.sha2(F.col("text").cast("string"), 256), fresh_name(docs, "text_sha256")
        verdict = checkpointed(contamination(docs.select(key.alias("doc_id"), "text"), benchmark).where("contaminated").select(F.col("doc_id").alias(name)).distinct())
        few = verdict.count() <= BROADCAST_ROWS
        return docs.join(F.broadcast(verdict) if few else verdict, key == F.col(name), "left_anti")
    shared = docs.sparkSession.sparkContext.broadcast(Probe(block))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = shared.value
        follow = Chains(probe)
        for b in sliced(batches):
            mask = []
            for n, hits, _, _ in scan_texts(octets(b.column("text")), probe, follow):
                hit = sum(e - s for s, e in hits)
                mask.append(not (hit > 0 and SHARE * hit >= n))
            yield b.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
