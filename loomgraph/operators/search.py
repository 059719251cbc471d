"""Full-text ranking and exact vector search, with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75

#: Letters with marks and what an accent-folding analyser makes of them (fixed values).
_MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def fold(text: Column) -> Column:
    return F.translate(F.lower(text), _MARKED, _PLAIN)


def tokens(text: Column, folding: bool = True) -> Column:
    """Words of letters, digits and underscores, in lower case, accents folded on demand."""
    low = fold(text) if folding else F.lower(text)
    return F.filter(F.split(low, r"[^\p{L}\p{N}_]+"), lambda x: x != "")


def weight() -> Column:
    """BM25 of a term in a document: columns tf, length, df, and over all documents n and mean."""
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))


def inverted_index(docs: DataFrame, key: str, fields: list[str], folding: bool = True) -> DataFrame:
    """key, term, tf, length: one row per document and term over the named text columns."""
    words = docs.select(key, tokens(F.concat_ws(" ", *fields), folding).alias("words"))
    length = F.size("words").alias("length")
    return words.select(key, length, F.explode("words").alias("term")).groupBy(key, "length", "term").agg(F.count(F.lit(1)).alias("tf"))


def bm25(docs: DataFrame, key: str, fields: list[str], query: list[str], k: int = 10, folding: bool = True) -> DataFrame:
    """key, score of the k best documents for the query's terms; ties by key.

    Only the query's terms leave the tokeniser: term counts per document, document counts and the mean length.
    """
    words = docs.select(key, tokens(F.concat_ws(" ", *fields), folding).alias("words"))
    facts = words.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean"))
    wanted = sorted(set(query))
    counts = words.select(key, F.size("words").alias("length"), F.explode(F.filter("words", lambda x: x.isin(wanted))).alias("term")).groupBy(key, "length", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rows = counts.join(df, "term").join(facts, F.lit(True))
    return rows.groupBy(key).agg(F.round(F.sum(weight()), 6).alias("score")).orderBy(F.desc("score"), key).limit(k)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda t, v: t + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def neighbours(vectors: DataFrame, query: list[float], k: int = 10, key: str = "vec_id", name: str = "embedding") -> DataFrame:
    """key, similarity of the k vectors nearest by cosine, by an exact scan; ties by key."""
    wanted = F.array(*(F.lit(float(x)) for x in query))
    return vectors.where(F.size(name) == len(query)).select(key, F.round(cosine(F.col(name), wanted), 6).alias("similarity")).orderBy(F.desc("similarity"), key).limit(k)


def width_errors(vectors: DataFrame, dimensions: int, name: str = "embedding") -> DataFrame:
    """Rows whose vectors are not as wide as declared."""
    return vectors.where(F.col(name).isNull() | (F.size(name) != dimensions))


def constant_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """field, values, constant: distinct values of each, white space normalised and blanks left out."""
    clean = lambda c: F.trim(F.regexp_replace(F.col(c).cast("string"), r"\s+", " "))
    counted = rows.agg(*(F.countDistinct(F.when(clean(c) != "", clean(c))).alias(c) for c in fields))
    return counted.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("values")) for c in fields))).alias("x")).select("x.field", "x.values", (F.col("x.values") <= 1).alias("constant"))


def stale(texts: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(to encode, reusable) of name, text against stored name, hash, vector: changed, new or vectorless texts are stale."""
    now = texts.withColumn("hash", F.concat(F.lit("sha256:"), F.sha2("text", 256)))
    had = stored.select("name", F.col("hash").alias("old_hash"), "vector")
    both = now.join(had, "name", "left")
    fresh = F.col("old_hash").isNull() | (F.col("hash") != F.col("old_hash")) | F.col("vector").isNull()
    return both.where(fresh).select("name", "text", "hash"), both.where(~fresh).select("name", "text", "hash", "vector")
