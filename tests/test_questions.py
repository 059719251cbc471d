"""Questions without SQL, against brute force over small graphs."""

from collections import Counter, defaultdict, deque

import pytest

from loomgraph import catalog
from loomgraph.model import Graph
from loomgraph.sources import tables

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def graph(spark):
    return tables.graph(spark, SF)


def brandes(pairs):
    out = defaultdict(set)
    for a, b in pairs:
        if a != b:
            out[a].add(b)
    score = Counter()
    for s in {x for p in pairs for x in p}:
        order, before, paths, distance, queue = [], defaultdict(list), Counter({s: 1}), {s: 0}, deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in out[v]:
                if w not in distance:
                    distance[w] = distance[v] + 1
                    queue.append(w)
                if distance[w] == distance[v] + 1:
                    paths[w] += paths[v]
                    before[w].append(v)
        gained = Counter()
        for w in reversed(order):
            for v in before[w]:
                gained[v] += paths[v] / paths[w] * (1 + gained[w])
            if w != s:
                score[w] += gained[w]
    return score


def test_bridges_count_paths_from_every_source(graph):
    want = brandes([(r.source, r.target) for r in graph.chains.select("source", "target").distinct().collect()])
    assert len(want) > 64
    got = catalog.l4_bridges(graph).collect()
    assert [r.betweenness for r in got] == pytest.approx(sorted((round(x, 2) for x in want.values()), reverse=True)[:10], abs=0.011)
    assert all(r.betweenness == pytest.approx(want[r.concept], abs=0.011) for r in got)


def test_exclusive_concepts_over_all_orders(spark, graph):
    few = [("1-1", "1", "a"), ("1-2", "1", "a"), ("51-1", "51", "b"), ("2-1", "2", "b"), ("50-1", "50", "c"), ("7-1", "7", "c"), ("7-2", "7", "d")]
    names = spark.createDataFrame([(x,) for x in "abcde"], "name string").selectExpr("name", "name AS search_name")
    lines = spark.createDataFrame(few, "item_id string, ref string, concept string")
    sources = spark.createDataFrame([(r, f"Order {r}") for r in {x[1] for x in few}], "bibtex string, title string")
    changed = {"concepts": names, "sources": sources, "from_source": lines.select("item_id", "ref"), "items": lines.select("item_id"), "mentions": lines.selectExpr("item_id", "concept", "1 AS mention_order"), "chains": graph.chains.limit(0), "located": None}
    got = [tuple(r) for r in catalog.l20_exclusive(Graph(**{**graph.__dict__, **changed})).collect()]
    assert got == [("a", "Order 1", 2), ("d", "Order 7", 1)]


def test_exclusive_concepts_of_the_tables(graph):
    found = defaultdict(set)
    for r in graph.mentions.join(graph.from_source, "item_id").select("concept", "ref").distinct().collect():
        found[r.concept].add(r.ref)
    assert {r.concept for r in catalog.l20_exclusive(graph).collect()} == {c for c, refs in found.items() if len(refs) == 1}


def test_aliases_of_all_parts(spark):
    """Over more than 400 parts."""
    low, name_of = {}, {r.p_partkey: r.p_name for r in tables.read(spark, LARGER, "part").collect()}
    for k, name in name_of.items():
        low[name] = min(k, low.get(name, k))
    assert any(k > 400 and low[n] != k for k, n in name_of.items())
    want = Counter()
    for r in tables.graph(spark, LARGER).chains.select("source", "target").collect():
        a, b = (str(low[name_of[int(x)]]) for x in r)
        if a != b:
            want[a, b] += 1
    assert {(r.source, r.target): r.n for r in catalog.e9_aliases(spark, LARGER).collect()} == want


def planted(spark, graph):
    """Three cliques of ten, joined in a row; part 7 is in the second."""
    groups = {"a": [f"a{i}" for i in range(10)], "b": ["7", *(f"b{i}" for i in range(9))], "c": [f"c{i}" for i in range(10)]}
    pairs = [(x, y) for c in groups.values() for i, x in enumerate(c) for y in c[:i]] + [("a1", "b0"), ("b0", "c1"), ("c2", "b1")]
    names = [x for c in groups.values() for x in c]
    concepts = spark.createDataFrame([(x, x) for x in names], "name string, search_name string")
    chains = spark.createDataFrame([(f"i{i}", *p, "R") for i, p in enumerate(pairs)], "item_id string, source string, target string, type string")
    said = spark.createDataFrame([(f"m{i}", x, 1) for i, x in enumerate(names)], "item_id string, concept string, mention_order int")
    at = said.selectExpr("item_id", "concat('s', length(concept)) AS ref")
    values = spark.createDataFrame([(x, "topic", "Brand#23", 0) for x in names], "concept string, field string, value string, ord int")
    g = Graph(**{**graph.__dict__, "concepts": concepts, "chains": chains, "mentions": said, "from_source": at, "items": at.select("item_id"), "values": values, "located": None})
    return g, groups, pairs


def test_questions_about_computed_ranks_and_communities(spark, graph):
    g, groups, pairs = planted(spark, graph)
    names = [x for c in groups.values() for x in c]
    rank, out = dict.fromkeys(names, 0.15), Counter(a for a, _ in pairs)
    for _ in range(20):
        flow = Counter()
        for a, b in pairs:
            flow[b] += rank[a] / out[a]
        rank = {x: 0.15 + 0.85 * flow[x] for x in names}
    first = {min(c): c for c in groups.values()}
    top = lambda some: [(x, pytest.approx(round(rank[x], 4), abs=1.1e-4)) for x in sorted(some, key=lambda x: (-round(rank[x], 4), x))[:10]]
    assert [(r.concept, r.pagerank) for r in catalog.l3_top_pagerank(g).collect()] == top(names)
    assert [(r.concept, r.pagerank) for r in catalog.l24_central_of_community(g).collect()] == top(groups["b"])
    got = {r.community: (r.concepts, r.average_pagerank) for r in catalog.l18_compare_communities(g).collect()}
    assert got == {k: (10, pytest.approx(sum(rank[x] for x in c) / 10, abs=1e-4)) for k, c in first.items()}
    assert {r.community: (r.total, r.examples) for r in catalog.l5_communities(g).collect()} == {k: (10, ",".join(sorted(c)[:5])) for k, c in first.items()}
    want = brandes(pairs)
    bridges = catalog.l4_bridges(g).collect()
    assert bridges and all(r.betweenness == pytest.approx(want[r.concept], abs=0.011) and r.pagerank == pytest.approx(rank[r.concept]) and r.concept in first[r.community] for r in bridges)


def test_questions_about_communities_hold_no_graph_in_one_task(graph, monkeypatch):
    assert catalog._metric_table.__defaults__ == (catalog.algorithms.louvain,)  # l4, l18, l24
    monkeypatch.setattr(catalog.algorithms, "louvain_in_one_task", None)
    assert set(catalog.l5_communities(graph).columns) == {"community", "total", "examples"}


def test_bridges_number_the_graph_once(graph, monkeypatch):
    calls, numbered = [], catalog.algorithms.numbered
    monkeypatch.setattr(catalog.algorithms, "numbered", lambda names: calls.append(1) or numbered(names))
    catalog.l4_bridges(graph)
    assert len(calls) == 1
