"""Incremental ingestion: each batch of a stream is upserted into stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loomgraph.sources import sinks


def upsert_into(path: str, key: list[str]):
    """For foreachBatch: of a batch's rows with one key any one is taken; a repeated batch gives the same table."""

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            sinks.update(batch.dropDuplicates(key), path, key)

    return apply


def start(rows: DataFrame, path: str, key: list[str], checkpoint: str, once: bool = True) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(upsert_into(path, key)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
