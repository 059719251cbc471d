"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target, and its repetition rate is target / size.  A document is
taken floor(rate) times plus once more if its hash-seeded Bernoulli draw falls below the fraction.

Targets: all words of the corpus are shared out by weight; no source may get more than ``max_repeats`` times its own
size, and what it cannot take is shared among the others by weight until none is above.  With lambda the level at which
sum(min(cap, lambda * weight)) equals the total, that is min(cap, lambda * weight); lambda is the largest of the levels
found when the sources with the smallest cap / weight are capped one after the other, so prefix sums in that order give it.

Defined results: null text has size 0; null sources form one source, ordered last; a source without words has target 0;
a draw depends on doc_id (on the text where doc_id is null), so repeated rows are drawn alike; empty input, empty output.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import checkpointed, fresh_name, octets, running, sliced, with_facts

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 17


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the text by its number of words; bytes.split() splits at just the six ASCII white-space bytes."""
    for b in sliced(batches):
        n = pa.array([0 if t is None else len(t.split()) for t in octets(b.column("text"))], pa.int64())
        rest = [i for i, name in enumerate(b.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in rest), n], names=[*(b.schema.names[i] for i in rest), "size"])


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the key of the draw."""
    narrow = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"), F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")), F.lit("")).alias("draw_key"))
    fields = [f for f in narrow.schema.fields if f.name != "text"]
    return narrow.mapInArrow(_sizes, T.StructType([*fields, T.StructField("size", T.LongType())]))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, n (documents), source_size, weight, target; one row per source, which are ordered in parallel ranges."""
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    per = running(per, [F.col("source").asc_nulls_last()], [])
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long")).drop("place")
    per = running(per.withColumn("cap", F.col("source_size") * max_repeats), [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()], ["cap", "weight"])
    size, weight = per.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(size) - F.col("before_cap")).cast("double") / (F.lit(weight) - F.col("before_weight")).cast("double")
    top = per.agg(F.max(level)).first()[0]
    return per.select("source", "n", "source_size", "weight", F.least(F.col("cap").cast("double"), F.lit(top).cast("double") * F.col("weight")).alias("target"))


def copies_of(rate: Column, key: Column, seed: int = SEED) -> Column:
    """floor(rate), plus 1 where the draw is below the fraction.  52 bits of an MD5 make the draw."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def _rated(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return source_targets(sizes, weights, max_repeats).select(F.col("source").alias("mix_source"), F.col("n").alias("mix_n"), "source_size", "target", rate.alias("rate"))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    sizes = checkpointed(sized(docs))
    return (
        with_facts(sizes, _rated(sizes, weights, max_repeats), "source", "mix_source", "mix_n")
        .withColumn("copies", copies_of(F.col("rate"), F.col("draw_key"), seed))
        .select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def emitted(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each document's columns once per copy, with ``mix_copy`` counting from 1.

    Texts stay where they are: rates come to them.  A column of docs that is called mix_copy stays, and the count then gets
    underscores behind its name.
    """
    sizes = checkpointed(sized(docs))
    own = docs.columns
    name, source, n, rate, copies, count = (fresh_name(docs, x) for x in ("mix_source", "mix_of", "mix_n", "mix_rate", "mix_copies", "mix_copy"))
    rates = _rated(sizes, weights, max_repeats).select(F.col("mix_source").alias(name), F.col("mix_n").alias(n), F.col("rate").alias(rate))
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("string").cast("binary")), F.lit(""))
    return (
        with_facts(docs.withColumn(source, F.col("source").cast("string")), rates, source, name, n)
        .withColumn(copies, copies_of(F.col(rate), key, seed))
        .where(F.col(copies) > 0)
        .withColumn(count, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
        .select(*(F.col(f"`{c}`") for c in own), count)
    )


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, md5(text), '') AS draw_key,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM per),
levels AS (
  SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER before, 0))::DOUBLE
          / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(cap::DOUBLE, (max(level) OVER ()) * weight) AS target FROM levels),
rated AS (
  SELECT s.doc_id, s.source, s.size::BIGINT AS size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('17:' || s.draw_key), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copied AS (SELECT *, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM rated)
SELECT doc_id, source, size, source_size, target, rate, copies, copies * size AS taken FROM copied
"""
