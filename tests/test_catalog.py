"""Queries against their SQL, over the smallest tables."""

import duckdb
import pytest

from loomgraph import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = ["a14_counts", "b3_upsert_sources", "b8_mentions", "d10_visible_nodes", "e7_co_citation", "e9_aliases", "e10_merged_origins", "e11_tolerant_lookup", "f1_degrees", "f2_mention_counts", "f4_topic_weights", "f14_edges", "f16_hyperedges", "g2_slugs", "g4_evidence", "j_names", "j_items", "k2_pagerank", "k8_closure", "k9_within_two", "l12_topics", "b11_referring", "b12_project_context", "c15_inferred_root", "c18_entities", "e6_co_taxonomy", "f6_source_metrics", "f19_grouped_edges", "h7_sidecar", "i7_lost_to_a_higher_bar", "k5_whole_graph", "l25_context_lines", "m1_field_index", "m2_stemmed_terms", "m7_vectors", "m9_field_checks", "l20_exclusive", "l22_triangulated", "m3_bm25", "n_sessions"]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple("null" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in frame.values.tolist())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_sql_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert len(catalog.queries()) >= 100


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 200
