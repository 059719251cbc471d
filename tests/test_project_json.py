import json

import pytest

from loomgraph.operators import metrics, taxonomy, view
from loomgraph.sources import project_json

DOC = {
    "version": "3.0",
    "project": {"name": "demo", "description": "d"},
    "template": {
        "field_specs": {
            "links": {"type": "CHAIN", "scope": "ITEM", "relations": {"influences": "acts on"}},
            "codes": {"type": "CODE", "scope": "ITEM"},
            "why": {"type": "TEXT", "scope": "ITEM"},
            "memo": {"type": "MEMO", "scope": "ITEM"},
            "quote": {"type": "QUOTATION", "scope": "ITEM"},
            "group": {"type": "TOPIC", "scope": "ONTOLOGY"},
            "aspect": {"type": "ORDERED", "scope": "ONTOLOGY", "values": [{"index": 0, "label": "None"}, {"index": 2, "label": "Space"}]},
            "note_text": {"type": "TEXT", "scope": "ONTOLOGY"},
            "country": {"type": "TEXT", "scope": "SOURCE"},
        },
        "bundled_fields": {"ITEM": [["codes", "why"]]},
    },
    "ontology": {
        "Trust": {"description": "same", "note_text": "same", "group": "Social", "aspect": 0},
        "Market_Price": {"description": "own", "note_text": "other", "group": ["Money", "Social"], "aspect": [2, 99]},
        "old-trust": {"description": "alias"},
    },
    "corpus": [
        {"id": "b1", "source_ref": "@Ann2001", "data": {"links": [{"from": "trust ", "relation": "influences", "to": "Market_Price"}, {"from": "Market_Price", "relation": "part-of x", "to": "New"}, {"from": "", "relation": "r", "to": "x"}], "codes": "Trust", "memo": ["m1"], "quote": "said", "zone": ["a", "b"]}, "traceability": {"file": "/r/p/a.syn", "line": 0}},
        {"id": "b2", "source_ref": "@Bob", "data": {"codes": ["Trust", "Market_Price"], "why": ["w1"], "quote": "q2"}},
        {"id": "b3", "source_ref": "@Ann2001", "data": {"memo": "nothing"}},
        {"id": "b4", "source_ref": "@Bob", "data": {"links": [{"from": "old-trust", "relation": "is", "to": "Trust"}], "memo": "shared"}},
    ],
    "bibliography": {"ann2001": {"title": "A", "author": ["X", "Y"], "country": ""}},
    "dataset": {"ann2001": {"country": "BR", "title": "lost"}},
    "indices": {"aliases": {"old-trust": "Trust"}, "relations": {"KIND": [["trust", "Feeling"]], "PART": []}},
}


@pytest.fixture(scope="module")
def graph(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("json") / "p.json"
    path.write_text(json.dumps(DOC, ensure_ascii=False))
    return project_json.load(spark, str(path), root="/r/p")


def test_items_fan_out(graph):
    rows = {r.item_id: r for r in graph.items.collect()}
    assert set(rows) == {"b1_n0001", "b1_n0002", "b1_n0003", "b2_c0001", "b2_c0002", "b4_n0001"}
    assert [rows[f"b1_n000{i}"].description for i in (1, 2, 3)] == ["m1", "", ""]
    assert rows["b4_n0001"].description == "shared" and rows["b1_n0001"].citation == "said"
    assert (rows["b1_n0001"].source_file, rows["b1_n0001"].source_line) == ("a.syn", 0)
    assert rows["b1_n0001"].props == {"zone": "a, b", "why": None} or rows["b1_n0001"].props == {"zone": "a, b"}
    assert [rows[f"b2_c000{i}"].description for i in (1, 2)] == ["w1", ""]


def test_chains_and_mentions_use_the_ontology_spelling(graph):
    assert {(r.source, r.type, r.target, r.description) for r in graph.chains.collect()} == {("Trust", "INFLUENCES", "Market_Price", "acts on"), ("Market_Price", "PART_OF_X", "New", "")}
    got = {(r.item_id, r.concept, r.mention_order) for r in graph.mentions.collect()}
    assert ("b1_n0003", "Trust", 0) in got and ("b1_n0001", "Trust", 1) in got and ("b1_n0002", "New", 2) in got
    assert ("b4_n0001", "Trust", 1) in got and ("b4_n0001", "Trust", 2) in got


def test_concepts_values_sources(graph):
    c = {r.name: r for r in graph.concepts.collect()}
    assert set(c) == {"Trust", "Market_Price"} and c["Trust"].description is None and c["Market_Price"].description == "own"
    assert c["Trust"].aliases == ["old-trust"] and c["Market_Price"].search_name == "Market Price"
    v = sorted((r.concept, r.field, r.value) for r in graph.values.collect())
    assert v == [("Market_Price", "aspect", "99"), ("Market_Price", "aspect", "Space"), ("Market_Price", "group", "Money"), ("Market_Price", "group", "Social"), ("Trust", "aspect", "None"), ("Trust", "group", "Social")]
    s = {r.bibtex: r for r in graph.sources.collect()}
    assert set(s) == {"Ann2001", "Bob"} and s["Ann2001"].title == "A" and s["Ann2001"].props == {"country": "BR"} and s["Ann2001"].author == "X, Y"
    assert graph.concept_label == "Links" and graph.topic_field == "group"
    assert [tuple(r) for r in graph.hierarchy.select("child", "parent", "type").collect()] == [("Trust", "Feeling", "KIND_OF")]


def test_metrics_of_the_project(graph):
    d = {r.name: (r.out_degree, r.in_degree, r.degree) for r in metrics.degrees(graph).collect()}
    assert d == {"Trust": (1, 0, 1), "Market_Price": (1, 1, 2), "New": (0, 1, 1)}
    m = {r.name: (r.mention_count, r.source_count) for r in metrics.mention_counts(graph).collect()}
    assert m["Trust"] == (5, 2) and m["New"] == (1, 1)
    assert {(r.source, r.target, r.strength) for r in taxonomy.linked_topics(graph).collect()} == {("Social", "Money", 1)}
    assert {(r.name, r.group) for r in view.groups(graph, view.kept(graph, view.Scope())).collect()} == {("Trust", "Social"), ("Market_Price", "Money")}


def test_not_a_project(spark, tmp_path):
    (tmp_path / "x.json").write_text("{}")
    with pytest.raises(project_json.CompilationError):
        project_json.load(spark, str(tmp_path / "x.json"))
