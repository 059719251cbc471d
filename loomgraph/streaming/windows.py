"""Event-time windows; the same expressions serve static tables and streams with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def watermarked(events: DataFrame, late: str) -> DataFrame:
    """Streams forget state that is later than this; a watermark needs a time with a zone.  Static tables are as they are."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def _summed(events: DataFrame, *keys) -> DataFrame:
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def tumbling(events: DataFrame, width: str, late: str = "10 minutes") -> DataFrame:
    rows = _summed(watermarked(events, late), F.window("ts", width).alias("w"), "event_type")
    return rows.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str, step: str, late: str = "10 minutes") -> DataFrame:
    rows = _summed(watermarked(events, late), F.window("ts", width, step).alias("w"))
    return rows.select(F.col("w.start").alias("start"), "n", "total")


def sessions(events: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    rows = watermarked(events, late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("user_id", F.col("w.start").alias("start"), "n")
