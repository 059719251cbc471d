import duckdb
import pandas as pd

from loomgraph.llm import common, mixing

ROWS = [(i, " ".join(["w"] * (i % 50)), f"s{i % 7}") for i in range(400)] + [(900, None, None), (901, "a\x0bb c", None), (None, "x y", "s1"), (3, "w w w", "s3"), (902, "tiny", "a"), (903, "", "zero")]


def frames(spark):
    return spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, source string, size long")


def test_against_sql(spark):
    got = mixing.mixed(frames(spark)).toPandas()
    documents = pd.DataFrame(ROWS, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})  # noqa: F841
    want = duckdb.connect().execute(mixing.ORACLE_SQL).df()
    key = lambda f: sorted(map(repr, f[sorted(f.columns)].astype(object).where(f.notna(), None).astype(str).values.tolist()))
    assert len(got) == len(ROWS)
    assert sorted(got["taken"]) == sorted(want["taken"]) and sorted(got["target"].round(6)) == sorted(want["target"].round(6))
    assert key(got[["doc_id", "size", "taken"]].astype("Int64")) == key(want[["doc_id", "size", "taken"]].astype("Int64"))


def test_targets_fill_by_weight_up_to_three_sizes(spark):
    per = {r.source: r for r in mixing.source_targets(mixing.sized(frames(spark))).collect()}
    total = sum(r.source_size for r in per.values())
    assert abs(sum(r.target for r in per.values()) - total) < 1e-6
    assert all(r.target <= 3 * r.source_size for r in per.values())
    free = {round(r.target / r.weight, 6) for r in per.values() if r.target < 3 * r.source_size}
    assert len(free) == 1


def test_emitted_copies_agree_with_the_mix(spark):
    docs = frames(spark)
    out = mixing.emitted(docs)
    assert out.columns == [*docs.columns, "mix_copy"]
    assert out.count() == mixing.mixed(docs).agg({"copies": "sum"}).first()[0]
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(i, "a b c", f"s{i % 3}", 1.5, i, "c", 7) for i in range(40)] + [(41, None, None, 0.0, 0, "c", 7)], "doc_id long, text string, source string, mix_rate double, mix_copies int, mix_source string, mix_copy int")
    out = mixing.emitted(docs)
    assert out.columns == [*docs.columns, "mix_copy_"]
    rows = out.collect()
    assert len(rows) == mixing.mixed(docs).agg({"copies": "sum"}).first()[0]
    assert {(r.mix_copies == r.doc_id, r.mix_rate, r.mix_source, r.mix_copy) for r in rows} == {(True, 1.5, "c", 7)}


def test_many_sources_without_a_broadcast(spark, monkeypatch):
    rows = [(i, " ".join(["w"] * (i % 9)), "hot" if i % 3 == 0 else f"s{i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few = {(r.doc_id, r.target, r.taken) for r in mixing.mixed(docs).collect()}
    monkeypatch.setattr(mixing, "with_facts", lambda *a: common.with_facts(*a, limit=10))
    assert {(r.doc_id, r.target, r.taken) for r in mixing.mixed(docs).collect()} == few
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"])  # noqa: F841
    want = duckdb.connect().execute(mixing.ORACLE_SQL).fetchall()
    assert {(r[0], round(r[4], 9), r[7]) for r in want} == {(a, round(b, 9), c) for a, b, c in few}
