"""Write semantics: rebuild, upsert, and a marker for loads that did not finish."""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.errors import StoreError

STALE_SECONDS = 900


def upserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows replace old ones of the same key as a whole: columns that the new row lacks become null."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def rebuild(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def discard(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def replace(df: DataFrame, path: str) -> None:
    """Write a table that may be read from the same place: beside it first, then in its place."""
    spark = df.sparkSession
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return rebuild(df, path)
    staged, former = f"{path}.next", f"{path}.former"
    df.write.mode("overwrite").parquet(staged)
    files.delete(_path(spark, former), True)
    files.rename(_path(spark, path), _path(spark, former))
    files.rename(_path(spark, staged), _path(spark, path))
    files.delete(_path(spark, former), True)


def recovered(spark: SparkSession, path: str) -> None:
    """After a failure between the two renames of replace(): the former table takes its place again."""
    files, former = _files(spark, path), f"{path}.former"
    if not files.exists(_path(spark, path)) and files.exists(_path(spark, former)):
        files.rename(_path(spark, former), _path(spark, path))


def update(df: DataFrame, path: str, key: list[str]) -> None:
    """Upsert into a stored table.  The result goes to a new version beside it and then takes its place."""
    spark = df.sparkSession
    recovered(spark, path)
    replace(upserted(spark.read.parquet(path), df, key) if exists(spark, path) else df, path)


def replace_types(old: DataFrame, new: DataFrame, types: list[str]) -> DataFrame:
    """Hierarchy edges of the given types are replaced, others stay: the one case in which an update deletes."""
    return old.where(~F.col("type").isin(types)).unionByName(new)


@dataclass
class LoadState:
    status: str
    owner: str
    heartbeat: float

    @property
    def incomplete(self) -> bool:
        return self.status != "complete"

    def abandoned(self, now: float | None = None) -> bool:
        """A load in progress whose heartbeat is too old."""
        return self.incomplete and (time.time() if now is None else now) - self.heartbeat > STALE_SECONDS


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_state(spark: SparkSession, root: str, state: LoadState) -> None:
    """One small file, written through the file system: a sign of life should cost no job."""
    out = _files(spark, root).create(_path(spark, f"{root}/_load_state.json"), True)
    out.writeBytes(json.dumps(asdict(state)) + "\n")
    out.close()


def read_state(spark: SparkSession, root: str) -> LoadState | None:
    """The stored state; none means a complete graph of before there were states, or no graph."""
    if not exists(spark, f"{root}/_load_state.json"):
        return None
    held = _files(spark, root).open(_path(spark, f"{root}/_load_state.json"))
    line = held.readLine()
    held.close()
    return LoadState(**json.loads(line))


class Busy(StoreError):
    """Another load is running."""


def begin(spark: SparkSession, root: str, owner: str, now: float | None = None) -> None:
    now = time.time() if now is None else now
    state = read_state(spark, root)
    if state and state.incomplete and state.owner != owner and not state.abandoned(now):
        raise Busy(f"{state.owner} is loading {root}")
    write_state(spark, root, LoadState("in_progress", owner, now))


def beat(spark: SparkSession, root: str, owner: str, now: float | None = None) -> None:
    """The owner's sign of life, after each table it has written; another load that has taken over ends this one."""
    state = read_state(spark, root)
    if state is None or state.owner != owner:
        raise Busy(f"{state.owner if state else 'nobody'} has taken over {root}")
    write_state(spark, root, LoadState("in_progress", owner, time.time() if now is None else now))


def finish(spark: SparkSession, root: str, owner: str, now: float | None = None) -> None:
    write_state(spark, root, LoadState("complete", owner, time.time() if now is None else now))
