"""Training-corpus pipeline: quality, near-duplicates, contamination, secrets, mixture.

``STAGES`` lists (name, function); each takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again
as the next one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import decontam, mixing, quality, secrets, simhash
from loomgraph.llm.common import discard, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.  It learns from the labelled rows among docs."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id."""
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without, or with few, words of benchmark items."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def scrub_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.scrubbed(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target; ``mix_copy`` counts the copies of one."""
    return mixing.emitted(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret scans", scrub_secrets),
    ("source mixing", mix_sources),
]

#: A fitted network and compression cannot be expressed in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again by the next."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, path = written(stage(spark, docs, sf_dir), "stage")
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
