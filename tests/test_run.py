import json

import pytest

from loomgraph.operators import view
from loomgraph.plans import run
from loomgraph.sources import sinks
from loomgraph.streaming import ingest, windows
from tests.test_project_json import DOC


@pytest.fixture
def project(tmp_path):
    path = tmp_path / "demo.json"
    path.write_text(json.dumps(DOC))
    return str(path)


def test_rebuild_then_update(spark, project, tmp_path):
    root = str(tmp_path / "graph")
    first = run.run(spark, [project], root, choice="fast")
    assert first.success, first.error
    assert first.stats["items"] == 6 and first.stats["sources"] == 2
    again = run.run(spark, [project], root, mode="update", choice="none")
    assert again.success, again.error
    assert spark.read.parquet(f"{root}/items").count() == 6
    assert "pagerank" not in spark.read.parquet(f"{root}/concept_metrics").columns
    assert sinks.read_state(spark, root).status == "complete"


def test_page_and_errors(spark, project, tmp_path):
    out = tmp_path / "p.html"
    assert run.run(spark, [project], str(out), backend="html", scope=view.Scope()).success
    assert "Market_Price" in out.read_text() and "const NODES" in out.read_text()
    assert not run.run(spark, [project, project], str(out), backend="html").success
    assert isinstance(run.run(spark, [str(tmp_path / "none.json")], "x").error, Exception)


def test_load_state(spark, tmp_path):
    root = str(tmp_path / "g")
    assert sinks.read_state(spark, root) is None
    sinks.begin(spark, root, "a", now=1000.0)
    with pytest.raises(sinks.Busy):
        sinks.begin(spark, root, "b", now=1500.0)
    sinks.begin(spark, root, "b", now=2000.0)
    assert sinks.read_state(spark, root).owner == "b"


def test_stream_of_upserts_and_windows(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(source)
    stream = spark.readStream.schema("id long, v string").parquet(source)
    ingest.start(stream, str(tmp_path / "t"), ["id"], str(tmp_path / "c")).awaitTermination()
    spark.createDataFrame([(2, "new"), (3, "c")], "id long, v string").write.mode("append").parquet(source)
    ingest.start(stream, str(tmp_path / "t"), ["id"], str(tmp_path / "c")).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {(1, "a"), (2, "new"), (3, "c")}
    events = spark.readStream.schema(spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema).parquet("/root/testdata/sf0.001/events.parquet*")
    q = windows.tumbling(events, "1 day").writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("days").agg({"n": "sum"}).first()[0] == 1000
