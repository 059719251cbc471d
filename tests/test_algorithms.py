import numpy as np
import pytest

from loomgraph.operators import algorithms as alg
from loomgraph.operators import taxonomy


def edges(spark, pairs):
    return spark.createDataFrame([(a, b, 1) for a, b in pairs], "source string, target string, weight long")


def test_pagerank_follows_the_recurrence(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("d", "a")]
    got = {r.name: r.pagerank for r in alg.pagerank(edges(spark, pairs), rounds=7).collect()}
    rank = dict.fromkeys("abcd", 0.15)
    out = {x: sum(p[0] == x for p in pairs) for x in "abcd"}
    for _ in range(7):
        rank = {x: 0.15 + 0.85 * sum(rank[a] / out[a] for a, b in pairs if b == x) for x in "abcd"}
    assert got == pytest.approx(rank)


@pytest.mark.parametrize("local", [10**6, 0])
def test_betweenness_of_closed_forms(spark, local):
    path = [(f"n{i}", f"n{i + 1}") for i in range(4)]
    got = {r.name: r.betweenness for r in alg.betweenness(edges(spark, path), local_edges=local).collect()}
    assert got == pytest.approx({f"n{i}": i * (4 - i) for i in range(5)})
    diamond = [("s", "a"), ("s", "b"), ("a", "t"), ("b", "t")]
    got = {r.name: r.betweenness for r in alg.betweenness(edges(spark, diamond), local_edges=local).collect()}
    assert got == pytest.approx({"s": 0, "a": 0.5, "b": 0.5, "t": 0})


def test_betweenness_stays_within_components(spark):
    path = [(f"{c}{i}", f"{c}{i + 1}") for c in "abc" for i in range(4)]
    got = {r.name: r.betweenness for r in alg.betweenness(edges(spark, path)).collect()}
    assert got == pytest.approx({f"{c}{i}": i * (4 - i) for c in "abc" for i in range(5)})
    u, v = np.array([0, 3, 5]), np.array([2, 1, 3])
    assert alg._components(6, u, v).tolist() == [0, 1, 0, 1, 4, 1]


@pytest.mark.parametrize("alone", [0.001, 1, 10**9])
def test_betweenness_steps_of_each_kind_are_equal(monkeypatch, alone):
    """Along pairs or over whole blocks, with a hub of several rows, by one source after the other."""
    rng = np.random.default_rng(1)
    n = 200
    u, v = np.divmod(np.unique(np.concatenate([rng.integers(0, n * n, 500), np.arange(1, n), np.arange(1, n) * n])), n)
    u, v = u[u != v], v[u != v]
    want = np.zeros(n)
    for s in range(n):
        distance, paths, levels = {s: 0}, np.zeros(n), [[s]]
        paths[s] = 1
        while levels[-1]:
            step = np.isin(u, levels[-1]) & ~np.isin(v, list(distance))
            np.add.at(paths, v[step], paths[u[step]])
            levels.append(np.unique(v[step]).tolist())
            distance.update(dict.fromkeys(levels[-1], len(levels) - 1))
        far, gained = np.array([distance.get(x, -9) for x in range(n)]), np.zeros(n)
        for d in range(len(levels) - 1, 0, -1):
            step = (far[u] == d - 1) & (far[v] == d)
            np.add.at(gained, u[step], paths[u[step]] / paths[v[step]] * (1 + gained[v[step]]))
        gained[s] = 0
        want += gained
    monkeypatch.setattr(alg, "ALONE", alone)
    assert alg._local_brandes(alg.Adjacency(n, u, v), np.arange(n)) == pytest.approx(want)


@pytest.mark.parametrize("alone", [0.001, 15, 10**9])
@pytest.mark.parametrize("kept", [0, 100, 10**6])
@pytest.mark.parametrize("deep", [3, 8, 14, 40])
def test_betweenness_of_many_shortest_paths(monkeypatch, alone, kept, deep):
    """Three vertices a layer, each with all of the next: 3 ** 39 paths are more than two, four or eight bytes hold."""
    monkeypatch.setattr(alg, "ALONE", alone)
    monkeypatch.setattr(alg, "KEPT", kept)
    monkeypatch.setattr(alg, "CELLS", 50 * deep)  # 16 sources at once
    pairs = [(3 * i + a, 3 * i + 3 + b) for i in range(deep - 1) for a in range(3) for b in range(3)]
    u, v = np.array(pairs).T
    got = alg._local_brandes(alg.Adjacency(3 * deep, u, v), np.arange(3 * deep))
    assert got == pytest.approx(np.repeat([3 * i * (deep - 1 - i) for i in range(deep)], 3))


@pytest.mark.parametrize("held", [10**6, 0])
def test_metrics_over_one_numbering_are_the_same(spark, monkeypatch, held):
    pairs = cliques() + [("c3", "d"), ("d", "d"), ("d", "a1"), ("b2", "d")]
    e = spark.createDataFrame([(a, b, 1 + len(a + b) % 2 * 2) for a, b in pairs], "source string, target string, weight long").union(
        spark.createDataFrame([("a1", "", 2), ("", "b1", 1), ("b3", None, 4)], "source string, target string, weight long")
    )
    named, known = e.where("target is not null"), e.selectExpr("explode(array(source, target)) AS name").where("name <> ''").distinct()
    want = {r.name: r for r in alg.pagerank(e, known).join(alg.betweenness(named), "name").join(alg.louvain(named), "name").collect()}
    calls, numbered, louvain = [], alg.numbered, alg._louvain
    monkeypatch.setattr(alg, "_louvain", lambda *a, held_vertices: louvain(*a))  # its joins have a test of their own
    monkeypatch.setattr(alg, "numbered", lambda names: calls.append(1) or numbered(names))
    got = {r.name: r for r in alg.central(e, held_vertices=held).collect()}
    assert got.keys() == want.keys() and len(got) == 19 and (len(calls) == 1 or not held)
    for name, r in got.items():
        assert (r.pagerank, r.betweenness, r.community) == (pytest.approx(want[name].pagerank), pytest.approx(want[name].betweenness), want[name].community)


def test_betweenness_normalized_and_sampled(spark):
    star = [(f"x{i}", "hub") for i in range(5)] + [("hub", f"x{i}") for i in range(5)]
    got = {r.name: r.betweenness for r in alg.betweenness(edges(spark, star), normalized=True).collect()}
    assert got["hub"] == pytest.approx(1.0) and got["x1"] == 0
    assert alg.betweenness(edges(spark, star), sample=3).count() == 6


def cliques():
    pairs = []
    for c in "abc":
        pairs += [(f"{c}{i}", f"{c}{j}") for i in range(6) for j in range(i)]
    return pairs + [("a0", "b0"), ("b0", "c0")]


def test_communities_are_the_planted_ones(spark):
    e = edges(spark, cliques())
    got = alg.louvain(e)
    assert {r.name: r.community for r in got.collect()} == {f"{c}{i}": f"{c}0" for c in "abc" for i in range(6)}
    assert alg.modularity(e, got) > 0.5


def test_communities_in_one_task_are_the_same_planted_ones(spark):
    got = alg.louvain_in_one_task(edges(spark, cliques()))
    assert {r.name: r.community for r in got.collect()} == {f"{c}{i}": f"{c}0" for c in "abc" for i in range(6)}


def test_communities_in_one_task_come_from_blocks(spark, monkeypatch):
    """The task never has the edges as rows: they come packed, and several blocks give what one gives."""
    pairs = [(f"v{i * i % 97}", f"v{i * 7 % 89}") for i in range(400)]
    want = {r.name: r.community for r in alg.louvain_in_one_task(edges(spark, pairs)).collect()}
    monkeypatch.setattr(alg, "BLOCK_EDGES", 100)
    seen = []
    packed = alg._blocks
    monkeypatch.setattr(alg, "_blocks", lambda *a: seen.append(packed(*a)) or seen[-1])
    assert {r.name: r.community for r in alg.louvain_in_one_task(edges(spark, pairs)).collect()} == want
    assert seen[0].count() > 2 and seen[0].columns == ["block"]


def test_communities_over_tasks_and_in_one_task_are_equal(spark, monkeypatch):
    pairs = [(f"v{i * i % 97}", f"v{i * 7 % 89}") for i in range(400)]
    e = edges(spark, pairs).repartition(3)
    want = {r.name: r.community for r in alg.louvain_in_one_task(e).collect()}
    assert {r.name: r.community for r in alg.louvain(e).collect()} == want
    monkeypatch.setattr(alg, "BLOCK_EDGES", 50)
    assert {r.name: r.community for r in alg.louvain(e).collect()} == want


def test_communities_by_joins_are_the_planted_ones(spark):
    got = alg.louvain(edges(spark, cliques()), held_vertices=0)
    assert {r.name: r.community for r in got.collect()} == {f"{c}{i}": f"{c}0" for c in "abc" for i in range(6)}


def test_communities_settle_where_neighbours_keep_moving_past_each_other(spark):
    """All gains that vertices expect here never end: halves of a complete bipartite graph, and a random graph without communities."""
    n, rng = 400, np.random.default_rng(3)
    halves = np.repeat(np.arange(200), 200), 200 + np.tile(np.arange(200), 200)
    big = 20_000
    for size, a, b in ((n, *halves), (big, rng.integers(0, big, 4 * big), rng.integers(0, big, 4 * big))):
        u, v, weight = np.concatenate([a, b]), np.concatenate([b, a]), np.ones(2 * len(a))
        at = alg._in_memory([alg._block(u, v, weight, size)], size, weight.sum(), 1)[0]
        share = np.bincount(at, np.bincount(u, minlength=size), size) / len(u)
        quality = (at[u] == at[v]).mean() - share @ share
        assert quality >= (0.0 if size == n else 0.25) - 1e-9
    e = edges(spark, [(f"a{i}", f"b{j}") for i in range(30) for j in range(30)])
    assert alg.louvain(e).count() == alg.louvain_in_one_task(e).count() == 60


def test_a_pass_keeps_its_best_state():
    course = alg.Course()
    assert [course.over(i, q) for i, q in enumerate([0.1, 0.2, 0.15, 0.2005, 0.1])] == [False, False, False, True, True]
    assert (course.best, course.first, course.most) == (3, 0.1, 0.2005)
    course = alg.Course()
    assert [course.over(i, q) for i, q in enumerate([0.1, 0.05, 0.08])] == [False, False, True]
    assert (course.best, course.most) == (2, 0.08)


def test_closure_of_a_diamond_and_a_cycle(spark):
    up = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("x", "y"), ("y", "x")], "child string, parent string")
    got = {(r.node, r.ancestor): r.depth for r in taxonomy.closure(up).collect()}
    assert got[("a", "d")] == 2 and got[("x", "x")] == 0 and got[("x", "y")] == 1 and len(got) == 6 + 4 + 1 + 2


def test_choice_of_metrics_and_failures(spark):
    bad = spark.createDataFrame([("a",)], "source string")
    out = alg.compute(bad, "unknown")
    assert set(out) == {"pagerank", "betweenness", "community"} and all(isinstance(x, Exception) for x in out.values())
    assert alg.compute(bad, "none") == {}


def test_closure_of_more_than_64_levels(spark):
    up = spark.createDataFrame([(i, i + 1) for i in range(66)], "child int, parent int").coalesce(1)
    assert taxonomy.closure(up).where("node = 0").agg({"depth": "max"}).first()[0] == 66
