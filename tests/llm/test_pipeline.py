import hashlib
import re
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from loomgraph.llm import quality, secrets

sys.path.insert(0, str(Path(__file__).parent))

from test_decontam import words  # noqa: E402
from test_simhash import brute_components, brute_print  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_contaminated(text, items):
    """Windows of 13 words, or whole shorter items, by sets of joined words."""
    w = words(text)
    hit = set()
    for k in {min(13, len(x)) for x in items if x}:
        windows = {tuple(x[i : i + k]) for x in items if x and min(13, len(x)) == k for i in range(len(x) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
    return bool(hit) and 20 * len(hit) >= len(w)


def plain_copies(rows):
    """doc_id to copies, by the contract's shares and a draw from the MD5 of seed and doc_id."""
    size = lambda t: len(re.findall("[^\\x20\\x09-\\x0D]+", t or ""))
    of = {}
    for _, text, source in rows:
        of[source] = of.get(source, 0) + size(text)
    order = sorted(of, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(of.values()), set()
    while True:
        left = total - sum(3 * of[s] for s in capped)
        free = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * of[s]}
        if not above:
            break
        capped |= above
    target = {s: 3 * of[s] if s in capped else share[s] for s in order}
    out = {}
    for doc_id, _, source in rows:
        rate = target[source] / of[source] if of[source] else 0
        draw = int(hashlib.md5(f"17:{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        out[doc_id] = int(rate) + (draw < rate - int(rate))
    return out


def test_every_stage_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF).checkpoint()
        assert docs.columns == (columns if i < 4 else [*columns, "mix_copy"]), name
        rows = docs.collect()
        kept = {r.doc_id for r in rows}
        if i == 0:
            scores = quality.scored(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect()
            assert kept == {r.doc_id for r in scores if r.predicted}
            assert sum((d in kept) == (q == 1) for d, q in labels.items()) > 0.95 * len(labels)
        elif i == 1:
            assert kept == set(brute_components({d: brute_print(r.text) for d, r in before.items()}).values())
        elif i == 2:
            assert kept == {d for d, r in before.items() if not plain_contaminated(r.text, items)}
        elif i == 3:
            assert kept == set(before)
            for r in rows:
                assert (r.text or "").encode() == (secrets.redacted((before[r.doc_id].text or "").encode()) or b"")
                assert secrets.spans_of((r.text or "").encode())[0] == [] and r.n_chars == len(r.text or "")
        else:
            got = {}
            for r in rows:
                got.setdefault(r.doc_id, []).append(r.mix_copy)
            want = plain_copies([(r.doc_id, r.text, r.source) for r in before.values()])
            assert {d: sorted(c) for d, c in got.items()} == {d: list(range(1, n + 1)) for d, n in want.items() if n}


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert "mix_copy" in out.columns and out.count() > 0


ODD = [(1, None, "a", None), (1, None, "a", None), (2, "", "b", 0), (None, "some words that stand alone here", None, 32), (3, "same words in two rows", "a", 22), (4, "same words in two rows", "a", 22), (3, "same words in two rows", "a", 22)]


@pytest.mark.parametrize("place", range(5))
def test_stages_of_odd_rows(spark, place, tmp_path):
    """Nulls, repeats, ties, an empty table, and columns with clashing names."""
    name, stage = corpus_pipeline.STAGES[place]
    rows = [(*r, "x", 1, 2, 3) for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, score string, kept_id int, mix_rate int, predicted int")
    spark.createDataFrame([(1, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "quite other words"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, docs, str(tmp_path))
    assert out.columns[: len(docs.columns)] == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect())
    assert all((r[0] is None, r[0] or 0, r[1] or "") in {(d is None, d or 0, t or "") for d, t, *_ in ODD} for r in [(None if a else b, c) for a, b, c in got])
    if place == 1:  # no words at all are one group, equal texts another
        assert got == [(False, 1, ""), (False, 3, "same words in two rows"), (True, 0, "some words that stand alone here")]
    if place in (2, 3):
        assert len(got) == len(ODD)
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
