import numpy as np
import pytest

from loomgraph.llm import ann


def brute(rows, k, every):
    ids = sorted(rows)
    v = np.array([rows[i] for i in ids], np.float64)
    out = {}
    for q in ids:
        if q % every == 0:
            score = [(-float((v[ids.index(q)] * v[j]).sum()), i) for j, i in enumerate(ids) if i != q]
            out[q] = [(i, -s) for s, i in sorted(score)[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int")


def test_recall_ties_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(700, 16)).astype(np.float32)
    v[100:160] = v[100]
    v[300:340] = 3 * v[300]
    rows = dict(enumerate(v))
    got = {}
    for r in ann.nearest(frame(spark, rows.items()), k=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows, 10, 20)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, 11))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        for _, i, s in found:
            assert s == float((v[q].astype(float) * v[i].astype(float)).sum())
        hits += len({x[1] for x in found} & {x[0] for x in want[q]})
    assert hits / (10 * len(want)) >= 0.9
    # one of sixty equal vectors: its smallest siblings first
    assert [i for _, i, _ in got[120]][:10] == [i for i, _ in want[120]]


def test_unusable_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (20, [1, 1]), (1, [0, 0]), (2, [nan, 1]), (3, [inf, 1]), (4, None), (5, [1, 2, 3]), (None, [1, 1]), (20, [1, 1]), (7, [-1, 0])]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(frame(spark, rows)).collect())
    assert got == [(0, 1, 20, 1.0), (0, 2, 7, -1.0), (20, 1, 0, 1.0), (20, 2, 7, -1.0)]
    assert ann.nearest(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 65, 500])
def test_every_vector_has_one_leaf_in_every_tree(n):
    x = np.random.default_rng(n).normal(size=(n, 8))
    forest = ann.grown(x, float((x * x).sum(1).max() ** 0.5))
    leaf = forest.leaves(x)
    for t, tree in enumerate(forest.trees):
        # a vector on the cut itself may round to the other side
        assert np.abs(np.bincount(leaf[:, t], minlength=len(tree.sizes)) - tree.sizes).max() <= 2
    for pairs in forest.visited(x[:3], 1 << 60):
        assert sorted(pairs) == [(t, i) for t, tree in enumerate(forest.trees) for i in range(len(tree.sizes))]


def test_best_in_leaves_against_brute_force():
    rng = np.random.default_rng(5)
    v = rng.integers(-2, 3, size=(400, 5)).astype(float)  # many ties
    low, leaf = rng.permutation(400), rng.integers(0, 9, 400)
    q = rng.integers(-2, 3, size=(30, 5)).astype(float)
    wish = [np.flatnonzero(rng.random(9) < 0.6) for _ in q]
    pairs = np.repeat(np.arange(30), [len(w) for w in wish]), np.concatenate(wish)
    i, j, s = ann.best_in_leaves(q, pairs, v, leaf, low, 10)
    for n in range(30):
        own = [(-float((q[n] * v[x]).sum()), low[x]) for x in range(400) if leaf[x] in wish[n]]
        assert [(-a, low[b]) for a, b in zip(s[i == n], j[i == n], strict=True)] == sorted(own)[:11]


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_over_a_table_above_the_sample(spark, monkeypatch, clustered):
    """Leaves of several sampled vectors, shards in parts, queries in blocks: whole results, at the production k."""
    monkeypatch.setattr(ann, "SAMPLE", 1500)
    monkeypatch.setattr(ann, "LEAF", 64)
    monkeypatch.setattr(ann, "SHARD_ROWS", 150)
    monkeypatch.setattr(ann, "QUERY_ROWS", 20)
    rng = np.random.default_rng(7)
    v = rng.normal(size=(6000, 24))
    if clustered:
        v = rng.normal(size=(40, 24))[rng.integers(0, 40, 6000)] + 0.3 * v
        v[1000:3000] = v[1000] + 0.01 * v[1000:3000]  # a third of all in one place
    docs = spark.createDataFrame([(i, x.tolist(), 0, 0) for i, x in enumerate(v)], "vec_id long, embedding array<double>, score int, tree int")
    got = ann.nearest(docs).toPandas()
    score = v[::20] @ v.T
    score[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    truth = np.argsort(-score, axis=1, kind="stable")[:, : ann.K]
    assert len(got) == 300 * ann.K and got.groupby("query_id")["rank"].apply(lambda r: sorted(r) == list(range(1, 21))).all()
    hits = sum(len(set(g.vec_id) & set(truth[q // 20])) for q, g in got.groupby("query_id"))
    assert hits / (300 * ann.K) >= 0.9
