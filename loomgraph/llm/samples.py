"""What the classifiers have in common: held-out rows, bounded samples, word bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.llm.common import written


def fold_of(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod 4; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def is_held_out(doc_id: Column) -> Column:
    return fold_of(doc_id) == 2


def sampled(docs: DataFrame, labelled: DataFrame, per_label: int) -> tuple[DataFrame, str]:
    """doc_id, label and text of at most ``per_label`` documents of each label, in hash order.

    labelled: doc_id, label.  Only ids are ranked, and of those only the ones whose hash is so low that about twice as many
    as wanted remain of each label, however many there are.  The counts are a row a label, which any classifier must hold;
    callers bound the labels.  The sample is written; its folder comes along, to be discarded once the model is fitted.
    """
    span = 1 << 31
    hashed = labelled.select("doc_id", "label", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(span)).alias("draw"))
    counts = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    low = hashed.join(F.broadcast(counts), "label").where(F.col("draw") * F.col("n") < 2.0 * per_label * span)
    order = W.partitionBy("label").orderBy("draw", "doc_id")
    ids = low.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label).select("doc_id", "label")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    chosen = texts.join(F.broadcast(ids), "doc_id")
    once = chosen.withColumn("copy", F.row_number().over(W.partitionBy("doc_id").orderBy(F.xxhash64("text")))).where("copy = 1").drop("copy")
    return written(once, "sample")
