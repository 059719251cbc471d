import hashlib
import random
import re

import numpy as np
import pytest

from loomgraph.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = {}
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, t in items:
            x = words(t)
            k = min(13, len(x))
            for i in range(len(x) - k + 1 if x else 0):
                for j in range(len(w) - k + 1):
                    if w[j : j + k] == x[i : i + k]:
                        hit |= set(range(j, j + k))
                        found.add(str(item) if item is not None else "null")
        out[doc_id] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def made(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "Ämt", "x1", "And", "to", "été"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 12, 13, 14, 30])))) for i in range(12)]
    items += [(3, items[3][1]), (90, None), (None, "null item words here x1"), (91, "... !!")]
    docs = []
    for i in range(60):
        w = [rng.choice(vocab + ["zzz", "qqq"]) for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            x = (rng.choice(items)[1] or "").split()
            at = rng.randrange(len(w) + 1)
            w[at:at] = x
        docs.append((i, rng.choice([" ", "-", ".\n"]).join(w)))
    return docs + [(100, None), (101, ""), (102, "null-item words here X1"), (103, "the of " * 5000)], items


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_against_every_window(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontam, "SHARD_BYTES", 500)
    docs, items = made(4)
    d = spark.createDataFrame([(*x, "e") for x in docs], "doc_id long, text string, n_words string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.contamination(d, b).collect()}
    assert got == brute(docs, items)
    kept = {r.doc_id for r in decontam.clean(d, b).collect()}
    assert kept == {k for k, v in got.items() if not v[4]}


def test_longest_match_spans_windows(spark):
    item = " ".join(f"w{i}" for i in range(40))
    d = spark.createDataFrame([(1, "a b " + " ".join(f"W{i}" for i in range(5, 30)) + " c")], "doc_id long, text string")
    r = decontam.contamination(d, spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert (r.longest_match, r.hit_spans, r.n_hit) == (25, "2:27", 25)


def test_empty_tables_and_repeats(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.contamination(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "x")], "doc_id long, text string")
    assert decontam.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(docs, items).where("contaminated").count() == 2


@pytest.mark.parametrize("block", [1 << 24, 20])
def test_clean_judges_each_row_by_its_text(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    rows = [(None, "a b c"), (None, "other words"), (1, "d e f g h i j"), (1, "clean words"), (2, None), (None, None), (3, "a b c"), (3, "a b c")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c"), (2, "d e f g h i j"), (3, "k l m n o p q")], "item_id long, text string")
    got = sorted(map(tuple, decontam.clean(d, b).collect()), key=str)
    assert got == sorted([(None, "other words"), (1, "clean words"), (2, None), (None, None)], key=str)


def brute_longest(text, items):
    w, best = words(text), 0
    for _, t in items:
        x = words(t)
        k = min(13, len(x))
        for i in range(len(x) - k + 1 if x else 0):
            for j in range(len(w) - k + 1):
                n = 0
                while i + n < len(x) and j + n < len(w) and x[i + n] == w[j + n]:
                    n += 1
                best = max(best, n if n >= k else 0)
    return best


@pytest.mark.parametrize("rows", [2_000_000, 3])
def test_longest_match_against_brute_force(monkeypatch, rows):
    monkeypatch.setattr(decontam, "CHAIN_ROWS", rows)
    docs, items = made(9)
    shared = " ".join(f"s{i}" for i in range(30))
    items += [(200 + i, f"{shared} own{i} {shared}") for i in range(20)] + [(300, " ".join(f"s{i}" for i in range(10, 60)))]
    docs += [(400, shared + " own3 " + shared), (401, "x " + " ".join(f"s{i}" for i in range(5, 45))), (402, shared + " " + shared)]
    probe = decontam.Probe([("null" if i is None else str(i), (t or "").encode()) for i, t in items if t is not None])
    follow = decontam.Chains(probe, rows)
    got = list(decontam.scan_texts([t.encode() if t is not None else None for _, t in docs[:20] + docs[-7:] if t != docs[63][1]], probe, follow))
    want = [brute_longest(t, items) for _, t in docs[:20] + docs[-7:] if t != docs[63][1]]
    assert [x[3] for x in got] == want
    assert max(want) == 61


def test_windows_that_many_items_have_cost_one_match():
    text = " ".join(f"b{i}" for i in range(50))
    probe = decontam.Probe([(str(i), f"{text} tail{i}".encode()) for i in range(500)])
    ids = [probe.vocab[w] for w in decontam.words_of(text.encode())]
    at, _ = decontam.search(np.array(ids + [0] * 13, np.uint32), probe)
    assert len(at) == 50 - 12
    (n, spans, items, longest), = decontam.scan_texts([text.encode()], probe)
    assert (n, spans, len(items), longest) == (50, [(0, 50)], 500, 50)


def test_texts_over_a_shard_and_clashing_names(spark):
    item = " ".join(f"w{i}" for i in range(20))
    long = "filler text " * 400_000 + item + " end"  # over SHARD_BYTES, unpatched
    docs = spark.createDataFrame([(1, long, "a", 1), (2, item, "b", 2), (2, item, "b", 2)], "doc_id long, text string, text_sha256 string, hits int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.longest_match, r.contaminated) for r in decontam.contamination(docs, bench).collect())
    assert got == [(1, 800_021, 20, 20, False), (2, 20, 20, 20, True), (2, 20, 20, 20, True)]
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
