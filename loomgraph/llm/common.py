"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Texts are worked on in slices of at most so many rows (Spark bounds the bytes of a batch besides).
BATCH_ROWS = 2000
#: Rows of facts (sources, removed documents, hot keys) that may be broadcast; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of bounded length, whatever length the session gives its batches."""
    for b in batches:
        for s in range(0, max(1, b.num_rows), rows):
            yield b.slice(s, rows)


def fresh_name(df: DataFrame, wish: str) -> str:
    """A column name that df does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; local sessions may go without a name."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="loomgraph-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable, eager checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/loomgraph-{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """Write to the shared folder as Parquet and read back; columnar, so smaller than a checkpoint of wide rows."""
    path = shared_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def shown_text(raw: bytes) -> str:
    """The text of UTF-8 bytes; each ill-formed sequence counts as one replacement character."""
    return raw.decode("utf-8", "replace")


def octets(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null.  Strings of Spark may hold ill-formed bytes; they come as they are."""
    return column.cast(pa.binary() if column.type == pa.string() else pa.large_binary()).to_pylist()


def chunks(values: list, weight: Callable[[object], int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose summed weight stays near the limit; one heavy value is a range of its own."""
    start, held = 0, 0
    for i, value in enumerate(values):
        w = weight(value)
        if i > start and held + w > limit:
            yield start, i
            start, held = i, 0
        held += w
    if start < len(values):
        yield start, len(values)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def with_facts(rows: DataFrame, facts: DataFrame, left: str, right: str, n: str, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """rows joined (null-safe) with the one row of facts for their key, whatever share of them one key holds.

    n: the column of facts that counts the rows of a key; it and ``right`` go.  Up to ``limit`` facts are broadcast.  Of more,
    those of keys with over a two-thousandth of all rows are, which are two thousand at most; only the rest is shuffled.
    how: inner, or left for rows without facts.
    """
    facts = checkpointed(facts)
    on = lambda a, b: a[left].eqNullSafe(b[right])
    count, total = facts.agg(F.count(F.lit(1)), F.sum(n)).first()
    if count <= limit:
        few = facts.drop(n)
        return rows.join(F.broadcast(few), on(rows, few), how).drop(right)
    hot, cold = facts.where(F.col(n) * 2000 > total).drop(n), facts.where(F.col(n) * 2000 <= total).drop(n)
    often = rows.join(F.broadcast(hot), on(rows, hot)).drop(right)
    rest = rows.join(F.broadcast(hot.select(right)), on(rows, hot), "left_anti")
    return often.unionByName(rest.join(cold, on(rest, cold), how).drop(right))


def running(df: DataFrame, order: list[Column], sums: list[str]) -> DataFrame:
    """df with ``place`` (from 0) and, for each name in sums, ``before_<name>``: the sum over the rows before it in order.

    Ranges of rows are sorted in parallel; the driver gets one row of totals for each range.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    ranged = checkpointed(ranged.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    totals = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in sums)).orderBy("_range").collect()
    shifts, held = [], [0] * (1 + len(sums))
    for r in totals:
        shifts.append((r["_range"], *held))
        held = [h + (x or 0) for h, x in zip(held, r[1:], strict=True)]
    names = ["_shift", *(f"_shift_{c}" for c in sums)]
    shift = spark.createDataFrame(shifts, "_range int, " + ", ".join(f"{x} bigint" for x in names))
    within = W.partitionBy("_range").orderBy("_at")
    before = within.rowsBetween(W.unboundedPreceding, -1)
    out = ranged.withColumn("place", F.row_number().over(within) - 1)
    for c in sums:
        out = out.withColumn(f"before_{c}", F.coalesce(F.sum(c).over(before), F.lit(0)))
    out = out.join(F.broadcast(shift), "_range").withColumn("place", F.col("place") + F.col("_shift"))
    for c in sums:
        out = out.withColumn(f"before_{c}", F.col(f"before_{c}") + F.col(f"_shift_{c}"))
    return out.drop("_range", "_at", *names)
