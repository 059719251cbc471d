"""Project context, settings, linkage of projects, vectors, and what an update refuses."""

import copy
import json

import pytest

from loomgraph.errors import DependencyError, PipelineError, SettingsError, StoreError
from loomgraph.operators import embeddings, estimates, fulltext
from loomgraph.plans import context, run, settings
from loomgraph.sources import project_json, sinks
from tests.test_project_json import DOC


def member(name, field, spec, values):
    doc = copy.deepcopy(DOC)
    doc["project"] = {"name": name, "description": " told ", "metadata": {"by": "x"}, "questions": [{"id": "Q1", "text": "why?"}, {"id": "", "text": "no"}], "includes": [{"path": "p/a.syn"}]}
    doc["template"]["name"] = "T"
    doc["template"]["field_specs"][field] = {"type": "TEXT", "scope": "SOURCE", "location": {"file": "/secret"}, **spec}
    doc["template"]["required_fields"] = {"ITEM": ["quote"]}
    doc["export_metadata"] = {"timestamp": "2026-01-01", "compiler_version": "9"}
    doc["bibliography"] |= values
    return doc


@pytest.fixture(scope="module")
def projects(tmp_path_factory):
    root = tmp_path_factory.mktemp("projects")
    docs = {
        "crm": member("crm", "person", {"identifies": "card_holder"}, {"ann2001": {"person": ["p1 ", "p2"], "title": "A"}, "bob": {"person": "p1"}}),
        "shop": member("shop", "buyer", {"refers_to": "card_holder"}, {"ann2001": {"buyer": "p2"}, "bob": {"buyer": ["p9", "p1"]}}),
    }
    for name, doc in docs.items():
        (root / f"{name}.json").write_text(json.dumps(doc, ensure_ascii=False))
    return {name: str(root / f"{name}.json") for name in docs}


def test_run_of_two_projects_links_and_describes_them(spark, projects, tmp_path):
    root = str(tmp_path / "g")
    wanted = settings.StoreSettings(root, "english", settings.DEFAULT_ENCODER, ("note_text", "group"))
    done = run.run(spark, list(projects.values()), root, choice="none", wanted=wanted)
    assert done.success, done.error
    entities = {(r.label, r.entity_id, r.member, r.source_bibtex) for r in spark.read.parquet(f"{root}/entities").collect()}
    assert entities == {("CardHolder", "p1", "crm", "crm:@Ann2001"), ("CardHolder", "p2", "crm", "crm:@Ann2001")}
    refers = {(r.entity_id, r.from_source) for r in spark.read.parquet(f"{root}/refers_to").collect()}
    assert refers == {("p2", "shop:@Ann2001"), ("p1", "shop:@Bob")}
    assert {r.bibtex for r in spark.read.parquet(f"{root}/sources").collect()} == {"crm:@Ann2001", "crm:@Bob", "shop:@Ann2001", "shop:@Bob"}
    assert {r.name for r in spark.read.parquet(f"{root}/concepts").collect()} >= {"Trust", "Market_Price", "New"}
    c = context.read(spark, root)
    assert (c.project_name, c.description, c.template_name, c.compiler_version) == ("crm + shop", "told", "T", "9")
    assert c.source_count == 4 and c.embedding_fields == "note_text,group" and c.embedding_dimensions == 64
    assert "/secret" not in c.template_doc and "required `quote`" in c.template_doc and "**Q1** why?" in c.project_summary and "analyzer `english`" in c.project_summary
    vectors = spark.read.parquet(f"{root}/embeddings").collect()
    assert {r.name for r in vectors} == {"Trust", "Market_Price"} and all(abs(sum(x * x for x in r.vector) - 1) < 1e-9 for r in vectors)
    index = spark.read.parquet(f"{root}/fulltext")
    assert {r.id for r in fulltext.found(index.where("kind = 'concept'"), "markets", "english").collect()} == {"Market_Price"}
    # an update with another analyzer or other fields is refused, one that leaves them open is not
    again = run.run(spark, list(projects.values()), root, mode="update", choice="none", wanted=settings.StoreSettings(root, "german"))
    assert isinstance(again.error, StoreError) and "analyzer" in str(again.error)
    assert run.run(spark, list(projects.values()), root, mode="update", choice="none", wanted=settings.StoreSettings(root, "english")).success
    assert sinks.read_state(spark, root).status == "complete" and not sinks.exists(spark, f"{root}/_plan")


def test_root_is_inferred_from_includes(spark, projects):
    g = project_json.load(spark, projects["crm"])
    assert g.context["root"] == "/r" and g.context["warnings"] == []
    assert {r.source_file for r in g.items.collect()} == {"p/a.syn", None}
    files = spark.createDataFrame([(0, None), (1, "C:\\x\\q.syn"), (2, "D:\\y\\data\\a.syn"), (3, "/z/data/a.syn")], "b int, file string")
    assert project_json.root_of(files, ["data/a.syn"]) == "D:/y" and project_json.root_of(files, []) == "" and project_json.root_of(files, ["none"]) == ""


def test_settings(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text('[parquet]\ntarget = "t"\n[parquet.embeddings]\nfields = "one"\n[html]\nmax_nodes = 5\ngroup_by = "x"\n')
    assert settings.load(str(path), "parquet") == settings.StoreSettings("t", "standard", settings.DEFAULT_ENCODER, ("one",))
    assert settings.load(str(path), "html").scope.max_nodes == 5 and settings.load(str(path), "html").scope.group_by == "x"
    assert settings.load(None, "parquet") == settings.StoreSettings() and settings.load(str(tmp_path / "no"), "html") == settings.PageSettings()
    for text in ("parquet = 1", "[parquet]\nembeddings = 2", "[parquet.embeddings]\nfields = 3", "= broken"):
        path.write_text(text)
        with pytest.raises(SettingsError):
            settings.load(str(path), "parquet")
    with pytest.raises(SettingsError):
        settings.load(str(tmp_path / "missing"), "parquet")
    with pytest.raises(SettingsError):
        settings.load(None, "neither")


def test_vectors_are_kept_while_they_hold(spark, projects, tmp_path):
    g = project_json.load(spark, projects["crm"])
    path, encoder = str(tmp_path / "side"), embeddings.hashed(8)
    assert embeddings.read(spark, path) is None
    embeddings.write(embeddings.sidecar(g, ["note_text"], encoder), path)
    before = embeddings.read(spark, path)
    assert [r.name for r in before.collect()] == ["Market_Price", "Trust"]
    now = embeddings.texts(g, ["note_text"])
    stale = lambda model, fields: sorted(r.name for r in embeddings.to_encode(now, before, model, embeddings.fields_hash(fields))[0].collect())
    assert stale("hashed-8", ["note_text"]) == [] and stale("other", ["note_text"]) == ["Market_Price", "Trust"] == stale("hashed-8", ["note_text", "x"])
    embeddings.write(embeddings.sidecar(g, ["note_text"], embeddings.Encoder("hashed-8", 8, lambda: 1 / 0), before), path)  # nothing to encode: never loaded
    assert embeddings.read(spark, path).count() == 2
    spark.range(3).write.parquet(str(tmp_path / "odd"))
    assert embeddings.read(spark, str(tmp_path / "odd")) is None
    with pytest.raises(Exception, match="gave 3 numbers"):
        embeddings.encoded(now, embeddings.Encoder("bad", 4, lambda: lambda texts: [[1.0, 2.0, 3.0]] * len(texts))).collect()
    assert issubclass(DependencyError, PipelineError) and embeddings.sidecar_path("a/b.synp") == "a/b.embeddings"


def test_fields_are_checked(spark, projects):
    g = project_json.load(spark, projects["crm"])
    kept, warnings = embeddings.checked(g, ["note_text", "group"])
    assert kept == ["note_text", "group"] and len(warnings) == 1
    with pytest.raises(PipelineError, match="unknown ontology fields: nope"):
        embeddings.checked(g, ["nope"])


def test_estimates_and_small_rules():
    assert estimates.seconds(275_687, ["pagerank"]) == pytest.approx(11.03, rel=0.01)
    assert estimates.seconds(275_687, ["betweenness"], 2.0, 2 * 820_388) == pytest.approx(8 * 45 * 2.75687)
    assert estimates.seconds(0, ["pagerank"]) == 0 and estimates.calibration(0.0, 10) is None
    assert estimates.calibration(2 * estimates.seconds(100, ["pagerank"]), 100) == pytest.approx(2)
    assert context.without_locations({"a": [{"location": 1, "b": {"location": 2, "c": 3}}]}) == {"a": [{"b": {"c": 3}}]}
    assert fulltext.once(["title", "abstract", "title"]) == ["title", "abstract"]
    assert (fulltext.analyzer("Brazilian").name, fulltext.analyzer("org.x.StandardAnalyzer").folds, fulltext.analyzer("odd").name) == ("portuguese", False, "standard")
