"""The queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from loomgraph.llm import ann, chat, decontam, langid, licenses, lpf, mixing, quality, secrets, simhash
from loomgraph.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


def op3_lpf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf.deduplicated(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.by_replies(table(spark, sf_dir, "conversations"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_secrets, op3_lpf, op4_simhash, op5_langid, op6_licenses, op7_chat, op8_mixing, op9_decontamination, op10_ann, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op7_chat": chat.ORACLE_SQL, "op8_mixing": mixing.ORACLE_SQL}
