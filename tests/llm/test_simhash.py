import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from loomgraph.llm import common, simhash
from loomgraph.llm import components as cc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ümlaut", "ÉTÉ", "A B"]
    docs, base = [], []
    for i in range(150):
        if base and rng.random() < 0.6:
            w = list(rng.choice(base))
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 4, 30, 120]))]
            base.append(w)
        docs.append((i, rng.choice([" ", "\t", "\n \x0b"]).join(w).replace("w1", rng.choice(["w1", "W1"]))))
    return docs + [(500, None), (501, ""), (502, " \n")]


@pytest.mark.parametrize("small", [16, 2])
def test_against_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    docs = corpus(small)
    got = simhash.near_duplicates(spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, fp int")).collect()
    prints = {d: brute_print(t) for d, t in docs}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == brute_components(prints)
    kept = simhash.representatives(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(brute_components(prints).values()))


def test_every_pair_within_four_bits_shares_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x = int(rng.integers(0, 1 << 63))
        y = x
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            y ^= 1 << int(b)
        keys, rows = simhash.golay_keys(np.array([x, y], np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_decoding_is_perfect():
    every = np.arange(1 << 23)
    index = simhash.decode(every)
    assert index.min() == 0 and index.max() == 4095
    assert (np.bincount(index) == 2048).all()


def test_dense_bucket_gives_a_spanning_forest():
    rng = np.random.default_rng(2)
    prints = np.unique(np.array([int(np.bitwise_or.reduce(1 << rng.choice(12, 3))) for _ in range(900)], np.uint64))
    u, v = simhash.links_of(np.zeros(len(prints), np.int32), prints)
    want = brute_components({int(p): int(p) for p in prints})
    assert len(u) == len(prints) - len(set(want.values()))
    assert {int(a): int(b) for a, b in zip(u, v)} == {k: r for k, r in want.items() if k != r}


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r.u: r.root for r in cc.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)} | {5001: 5000}


def test_repeats_nulls_and_empty(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "completely other words stand here"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 5
    kept = sorted(map(tuple, simhash.representatives(docs).collect()), key=repr)
    assert kept == sorted([(1, "a b c d e"), (2, "completely other words stand here"), (None, None)], key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_columns_with_clashing_names_and_any_share_of_broadcasts(spark, monkeypatch):
    rows = [(i, f"one two three four {i % 7 if i < 90 else 'five'}", i, -i, 2 * i, "x", "y") for i in range(100)] + [(3, "one two three four 3", 1, 1, 1, "x", "y")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id long, kept_key int, loom_row_key int, gone_id string, GONE_KEY string")
    want = brute_components({r[0]: brute_print(r[1]) for r in rows})
    for limit in (200_000, 0):
        monkeypatch.setattr(simhash, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(simhash, "with_facts", lambda *a, limit=limit: common.with_facts(*a, limit=limit))
        kept = simhash.representatives(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
        assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == want


def test_facts_meet_hot_keys_and_nulls(spark):
    rows = [("hot", i) for i in range(3000)] + [(None, i) for i in range(50)] + [(f"k{i % 40}", i) for i in range(200)]
    frame = spark.createDataFrame(rows, "k string, v int")
    facts = frame.groupBy(frame.k.alias("of")).count().selectExpr("of", "count as n", "concat('f-', coalesce(of, 'null')) as fact")
    for limit in (1000, 0):
        got = common.with_facts(frame, facts, "k", "of", "n", limit=limit)
        assert common.with_facts(frame, facts.where("n < 6"), "k", "of", "n", "left", limit=limit).count() == len(rows)
        assert got.columns == ["k", "v", "fact"]
        assert sorted(map(repr, got.collect())) == sorted(repr(Row(k=k, v=v, fact=f"f-{k or 'null'}")) for k, v in rows)
