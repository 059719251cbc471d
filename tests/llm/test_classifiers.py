import pickle
import re
import zlib

import numpy as np
import pytest

from loomgraph.llm import langid, quality, samples

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.scored(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    assert quality.accepted(docs, labels).columns == docs.columns


def test_quality_of_nulls_repeats_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (2, "", 3), (None, "words here", 3)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert quality.scored(docs.limit(0), labels.limit(0)).count() == 0


def test_pooling_is_the_mean_of_word_vectors():
    vectors = np.zeros((3 + quality.RARE, quality.WIDTH), np.float32)
    vectors[:3, :3] = np.eye(3)
    vectors[3 + zlib.crc32(b"c") % quality.RARE, 4] = 1
    model = quality.Model(quality.Numbers({b"a": 0, b"b": 1, b"\x00again": 2}), vectors)
    x = model.pooled([b"a b b c", None])
    assert x[0, :5].tolist() == [0.25, 0.5, 0.25, 0, 0.25] and not x[1].any()
    again = pickle.loads(pickle.dumps(model))
    assert (again.pooled([b"a b b c unseen"]) == model.pooled([b"a b b c unseen"])).all()


def plain_score(model, text):
    """The score by loops over words."""
    tokens = (text or b"").split()
    shapes = re.sub(rb"[a-z\x80-\xff]", b"", re.sub(rb"[0-9]", b"0", re.sub(rb"[A-Z]", b"A", text or b""))).split()
    words = [*tokens, *(b"\x00" + s for s in shapes), *(b"\x00again" for a, b in zip(tokens, tokens[1:], strict=False) if a == b)]
    x = np.zeros(quality.WIDTH)
    known = dict(model.vocabulary)
    for w in words:
        x += model.vectors[known[w] if w in known else len(known) + zlib.crc32(w) % quality.RARE].astype(float) / max(1, len(tokens))
    mean, scale, w1, b1, w2, b2 = (np.asarray(p, float) for p in model.layers)
    hidden = [max(0.0, b1[j] + sum((x[i] - mean[i]) / scale[i] * w1[i, j] for i in range(quality.WIDTH))) for j in range(quality.HIDDEN)]
    logit = b2 + sum(h * w for h, w in zip(hidden, w2, strict=True))
    return 1 / (1 + np.exp(-np.clip(logit / model.temperature, -40, 40)))


def test_quality_against_loops_over_words(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fitted(docs, labels)
    long = "some Words here 12 12 and ünknown " * 200_000  # over CHUNK, unpatched
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, long), (-3, long)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(odd)
    text = {r.doc_id: r.text for r in every.collect()}
    got = quality.scored(every, labels, model).collect()
    assert len(got) == docs.count() + 4
    for r in got[:60] + got[-4:]:
        assert abs(r.score - plain_score(model, (text[r.doc_id] or "").encode())) < 1e-4


def test_quality_trains_on_what_it_scores(spark):
    """Few documents: no word is common, all share vectors by hash, and the sample's features are those of scoring."""
    docs = spark.createDataFrame([(i, f"w{i} same") for i in range(1, 5)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "doc_id long, quality int")
    model = quality.fitted(docs, labels)
    assert all(0 <= s <= 1 for s in model.scores([b"w1 same", None, b"never seen"]))


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97


def test_languages_of_odd_rows(spark):
    docs = spark.createDataFrame([(0, "the words of one text", "en", 1), (1, None, "en", 1), (2, "123 !!", "de", 1), (3, "", None, 1), (None, "wörter", None, 1)], "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in langid.predictions(docs).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert langid.predictions(docs.limit(0)).count() == 0
    none = docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang = 'x'")
    assert langid.predictions(docs, langid.fitted(none)).where("lang_pred <> 'und'").count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 7, 20])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert min(apart) >= (2 ** (n - 2) if n <= 7 else 10)


def test_long_texts_in_pieces(monkeypatch):
    text = ("the quick brown fox " * 500).encode()
    whole = langid.features([text])
    monkeypatch.setattr(langid, "CHUNK", 1000)
    assert np.abs(langid.features([text]) - whole).max() < 0.02


def test_sample_is_bounded_and_shared_out(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'t' as text", "if(id % 10 = 0, 'b', 'a') as label")
    got = {r.label: r["count"] for r in samples.sampled(docs, docs, 100)[0].groupBy("label").count().collect()}
    assert got == {"a": 100, "b": 100}


def plain_language(model, text):
    """Features by loops over n-grams, and decoding by explicit sums."""
    folded = b" " + bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in text) + b"   "
    row = np.zeros(langid.BUCKETS)
    for k, width in enumerate((2, 3, 4)):
        for i in range(len(folded) - width + 1):
            gram = folded[i : i + width]
            if gram[:2] != b"  ":
                h = (int.from_bytes(gram, "little") ^ (0x9E3779B9 * (k + 1) & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF
                h ^= h >> 15
                row[(h * 0xC2B2AE35 & 0xFFFFFFFF) >> 20] += 1
    row = np.log1p(row)
    row /= np.linalg.norm(row) or 1
    margins = [float(row @ model.weights[:, b].astype(float) + model.bias[b]) for b in range(model.codes.shape[1])]
    loss = [sum(model.trust[b] * np.log1p(np.exp(-c * m)) for b, (c, m) in enumerate(zip(code, margins, strict=True))) for code in model.codes]
    likely = np.exp(min(loss) - np.array(loss))
    return model.languages[int(np.argmin(loss))], float(likely.max() / likely.sum())


def test_languages_against_loops_over_grams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 4000")
    model = langid.fitted(docs)
    rows = [r.text.encode() for r in docs.limit(60).collect() if langid.has_letter((r.text or "").encode())]
    names, scores, _ = model.predict(rows)
    for text, name, score in zip(rows, names, scores, strict=True):
        want, likely = plain_language(model, text)
        assert name == want and abs(score - likely) < 2e-3


def test_only_letters_count_as_letters(spark):
    assert [langid.has_letter(t.encode()) for t in ("½ ²", "Ⅻ ①", "_9_", "ª", "中", "é", "a", "\u0301")] == [False, False, False, True, True, True, True, False]
    assert not langid.has_letter(b"\xff\xfe 1")
    docs = spark.createDataFrame([(1, "½ ² Ⅻ", "en"), (2, "word", "en"), (2, "word", "en"), (4, "wort", "de")], "doc_id long, text string, lang string")
    got = [(r.doc_id, r.lang_pred == "und", r.score == 0) for r in langid.predictions(docs).orderBy("doc_id").collect()]
    assert got == [(1, True, True), (2, False, False), (2, False, False), (4, False, False)]


def test_ill_formed_bytes_are_scored_and_scanned(spark):
    from loomgraph.llm import secrets

    docs = spark.sql("SELECT 1L AS doc_id, cast(unhex('FF6162') AS string) AS text, 'en' AS lang")
    assert langid.predictions(docs).first().doc_id == 1
    bad = spark.sql("SELECT 1L AS doc_id, cast(concat(unhex('FF'), cast('token = abcdefghijklmnop' AS binary)) AS string) AS text, 9L AS n_chars")
    assert secrets.findings(bad).first().spans == "assign:1:25"
    assert secrets.scrubbed(bad).count() == 1


def test_a_fault_in_the_language_column_is_named(spark):
    docs = spark.range(1300).selectExpr("id as doc_id", "'text' as text", "concat('l', id) as lang")
    with pytest.raises(ValueError, match="over 400 values"):
        langid.fitted(docs)
