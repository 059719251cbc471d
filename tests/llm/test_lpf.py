import hashlib
import random

import numpy as np
import pytest

from loomgraph.llm import lpf


def brute(docs, length=50):
    seen = {}
    for d, t in docs:
        if d is None:
            continue
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            seen[w] = min(seen.get(w, d), d)
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if d is not None and seen[raw[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("tion", "the", "éau", "x") for b in ("er", "and", "ß", "0")]
    line = " ".join(rng.choice(words) for _ in range(14))
    docs, texts = [], []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.5:
            t = rng.choice(texts)
            for _ in range(rng.randrange(3)):
                k = rng.randrange(len(t) + 1)
                t = t[:k] + rng.choice(["", "Q", " insert "]) + t[k + rng.randrange(3) :]
        elif texts and kind < 0.7:
            s = rng.choice(texts)
            k = rng.randrange(len(s) + 1)
            t = "head " * rng.randrange(9) + s[k : k + rng.randrange(200)] + line + line
        else:
            t = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 90)))
        texts.append(t)
        docs.append((i, t))
    docs += [(500, "a" * 400), (499, "b" + "a" * 60), (501, "ab" * 100), (502, "ab" * 30 + "c"), (503, None), (504, ""), (None, texts[0]), (3, texts[3]), (3, texts[5]), (505, "\x00" * 120), (506, "z" + "\x00" * 60)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("chunk,sorted_", [(2 << 20, 1_000_000), (700, 50)])
def test_against_every_window(spark, monkeypatch, chunk, sorted_):
    monkeypatch.setattr(lpf, "CHUNK", chunk)
    monkeypatch.setattr(lpf, "PIECE", chunk // 2)
    monkeypatch.setattr(lpf, "SORTED", sorted_)
    docs = corpus(chunk)
    got = lpf.deduplicated(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, chunk int").repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs)


def test_shard_against_every_window(monkeypatch):
    for seed in range(6):
        docs = [(d, t) for d, t in corpus(seed, 60) if d is not None]
        want = {}
        parts = []
        raw = b"".join((t or "").encode() for _, t in docs)
        starts = np.append(0, np.cumsum([len((t or "").encode()) for _, t in docs]))
        data = np.frombuffer(raw, np.uint8)
        h, first, size, content, text = lpf.segments(data, starts)
        doc = np.array([d for d, _ in docs])[text]
        body = lpf._gathered(data, first, size)
        assert (lpf.contents(body, np.cumsum(size) - size, size) == content).all()
        rows, begin, length = lpf.covered(h, content, doc, first, size, body, np.cumsum(size) - size)
        gone = np.zeros(len(raw), bool)
        for s, n in zip(begin, length):
            gone[s : s + n] = True
        for k, (d, t) in enumerate(docs):
            mine = gone[starts[k] : starts[k + 1]]
            parts.append((d, len(mine), int(mine.sum())))
        want = [x[:3] for x in brute(docs)]
        assert sorted(parts, key=repr) == sorted(want, key=repr)


def test_empty_and_kept_bytes(spark):
    docs = spark.createDataFrame([(2, "x" * 30 + "shared passage of more than fifty bytes, word for word. end"), (1, "shared passage of more than fifty bytes, word for word. other")], "doc_id long, text string")
    out = {r.doc_id: bytes(r.kept) for r in lpf.deduplicated(docs, kept_text=True).collect()}
    assert out[1].startswith(b"shared") and out[2] == b"x" * 30 + b"end"
    assert lpf.deduplicated(docs.limit(0)).count() == 0


def test_chunks_and_shards_without_anything_to_remove(spark):
    """Short texts only, and repeats that only one document has."""
    short = spark.createDataFrame([(1, "short"), (2, "short"), (3, "")], "doc_id long, text string").coalesce(1)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in lpf.deduplicated(short).collect()) == [(1, 5, 0), (2, 5, 0), (3, 0, 0)]
    alone = spark.createDataFrame([(7, "z" * 300), (8, "y" * 200)], "doc_id long, text string").coalesce(1)
    assert [r.n_removed for r in lpf.deduplicated(alone).collect()] == [0, 0]
    equal = spark.createDataFrame([(9, "z" * 300), (9, "z" * 300)], "doc_id long, text string").repartition(2)
    assert [r.n_removed for r in lpf.deduplicated(equal).collect()] == [0, 0]


def test_previous_factors_against_all_pairs():
    rng = random.Random(4)
    for floor, letters in ((1, "ab"), (3, "ab"), (1, "abc\x00"), (50, "ab")):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(12)]
        if floor == 50:
            texts += [t * 8 for t in texts] + ["ab" * 70, "ab" * 70, "a" * 90, "a" * 91]
        docs = [rng.randrange(6) for _ in texts]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        at, rest, doc, shown = [], [], [], []
        for t, d, s in zip(texts, docs, np.cumsum([0, *map(len, texts)]), strict=False):
            for i in range(len(t)):
                at.append(s + i)
                rest.append(len(t) - i)
                doc.append(d)
                shown.append(t[i:])

        def shared(a, b):
            return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

        want = [max((shared(a, b) for b, e in zip(shown, doc, strict=True) if e < d), default=0) for a, d in zip(shown, doc, strict=True)]
        got = lpf.previous_factors(data, np.array(at), np.array(rest), np.array(doc), floor)
        assert got.tolist() == [w if w >= floor else 0 for w in want]


def test_equal_hashes_of_different_segments_are_told_apart():
    texts = ["x" * 60 + "a", "x" * 60 + "b", "x" * 60 + "a", "y" * 50, "x" * 60 + "c"]
    data, size = np.frombuffer("".join(texts).encode(), np.uint8), np.array([len(t) for t in texts])
    at = np.cumsum(size) - size
    order, fresh = lpf.kinds(np.ones(5, np.uint64), np.full(5, 9, np.uint64), np.arange(5), at, size, data, at)
    groups = {}
    for k, i in zip(np.cumsum(fresh), order, strict=True):
        groups.setdefault(k, set()).add(texts[i])
    assert sorted(map(sorted, groups.values())) == sorted([t] for t in set(texts))


def test_nothing_is_left_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    lpf.deduplicated(spark.createDataFrame([(1, "some text")], "doc_id long, text string")).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_texts_over_a_chunk(spark):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefgh ") for _ in range(lpf.CHUNK + 70_000))
    docs = [(1, long), (2, "start " + long[100:9_000] + " mid " + long[-600:]), (3, long)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in lpf.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (len(long), 0, 0), 2: (len(docs[1][1]), 8_900 + 600, 2), 3: (len(long), len(long), 1)}
