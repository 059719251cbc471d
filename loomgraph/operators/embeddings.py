"""Vectors of concepts: what text stands for one, which vectors are out of date, and an encoder that can be exchanged.

The sidecar is a table: name, text, hash, vector, and the composition it was made with (model, dimensions, fields hash).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.errors import DependencyError, PipelineError
from loomgraph.functions import text
from loomgraph.model import Graph
from loomgraph.operators import search
from loomgraph.sources import sinks

SCHEMA_VERSION = 1
BATCH = 32
CLOSED = ("TOPIC", "ENUMERATED", "ORDERED")
READABLE = ("TEXT", "MEMO", "TOPIC")
SIDECAR = "name string, text string, hash string, vector array<double>, model string, dimensions int, fields array<string>, fields_hash string, schema_version int"


@dataclass(frozen=True)
class Encoder:
    """A model by name and width, and what loads it: a function without arguments that gives one from texts to vectors."""

    name: str
    dimensions: int
    load: Callable[[], Callable[[list[str]], list[Sequence[float]]]]


def hashed(dimensions: int = 64) -> Encoder:
    """An encoder that needs no model: each word adds 1 to the place that its MD5 names.  For tests and for first steps."""

    def load() -> Callable[[list[str]], list[list[float]]]:
        def encode(texts: list[str]) -> list[list[float]]:
            out = []
            for t in texts:
                v = [0.0] * dimensions
                for word in t.lower().split():
                    v[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dimensions] += 1.0
                out.append(v)
            return out

        return encode

    return Encoder(f"hashed-{dimensions}", dimensions, load)


def sidecar_path(project: str) -> str:
    """Beside the project, under its name: a/b.synp has a/b.embeddings."""
    path = PurePosixPath(project)
    return str(path.with_name(path.stem + ".embeddings"))


def fields_hash(fields: Sequence[str]) -> str:
    """Of the names in their order, since another order makes other texts."""
    return "sha256:" + hashlib.sha256("\x1f".join(fields).encode()).hexdigest()


def field_values(g: Graph, fields: Sequence[str]) -> DataFrame:
    """name and a column for each field: the concept's property, else its values of that field in order, joined by commas."""
    listed = g.values.where(F.col("field").isin(*fields)).groupBy("concept").pivot("field", list(fields)).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "value"))), lambda x: x["value"]), ", "))
    listed = listed.select(F.col("concept").alias("name"), *(F.col(f"`{f}`").alias(f"_{i}") for i, f in enumerate(fields)))
    rows = g.concepts.dropDuplicates(["name"]).join(listed, "name", "left")
    own = lambda f: F.col(f).cast("string") if f == "description" and f in g.concepts.columns else F.try_element_at("props", F.lit(f)).cast("string")
    return rows.select("name", *(F.coalesce(own(f), F.col(f"_{i}"), F.lit("")).alias(f) for i, f in enumerate(fields)))


def texts(g: Graph, fields: Sequence[str]) -> DataFrame:
    """name, text, hash: the readable name, then each field that says something; concepts without any text are left out."""
    rows = field_values(g, fields)
    parts: list[Column] = [text.humanized(F.col("name")), *(F.col(f"`{f}`") for f in fields)]
    return rows.select("name", text.concept_text(parts).alias("text")).where("name <> '' and text <> ''").withColumn("hash", text.text_hash(F.col("text")))


def checked(g: Graph, wanted: Sequence[str]) -> tuple[list[str], list[str]]:
    """(fields, warnings).  Unknown fields are an error; fields of one value are left out; closed ones are only remarked on."""
    declared = {n: str(s.get("type") or "TEXT").upper() for n, s in g.field_specs.items() if isinstance(s, dict) and str(s.get("scope") or "").upper() == "ONTOLOGY"}
    unknown = [f for f in wanted if f not in declared]
    if unknown or not declared:
        raise PipelineError(f"unknown ontology fields: {', '.join(unknown)}" if declared else "the template declares no ontology fields", "embeddings", f"known: {', '.join(sorted(declared))}")
    found = {r.field: r["values"] for r in search.constant_fields(field_values(g, wanted), list(wanted)).collect()}  # a row a field
    kept, warnings = [], []
    for f in wanted:
        if found[f] <= 1:
            warnings.append(f"{f} has {found[f]} distinct values and tells no concept from another; left out")
            continue
        if declared[f] in CLOSED:
            warnings.append(f"{f} is {declared[f]}: all concepts of a value share its text")
        elif declared[f] not in READABLE:
            warnings.append(f"{f} is {declared[f]}, which is no text")
        kept.append(f)
    if not kept:
        raise PipelineError("no field is left", "embeddings", "each has one value")
    return kept, warnings


def to_encode(now: DataFrame, before: DataFrame | None, model: str, composition: str) -> tuple[DataFrame, DataFrame | None]:
    """(stale, reusable) rows of texts(): all are stale under another model or composition, else changed and vectorless ones."""
    if before is None:
        return now, None
    same = before.where((F.col("model") == model) & (F.col("fields_hash") == composition)).select("name", "hash", "vector")
    stale, kept = search.stale(now.select("name", "text"), same)
    return stale, kept


def encoded(rows: DataFrame, encoder: Encoder, batch: int = BATCH) -> DataFrame:
    """name, text, hash, vector of unit length.  Each task loads the encoder once, and only if it has rows."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for b in batches:
            for s in range(0, b.num_rows, batch):
                part = b.slice(s, batch)
                if model is None:
                    try:
                        model = encoder.load()
                    except Exception as e:
                        raise DependencyError(f"the encoder {encoder.name} cannot be loaded", details=f"{type(e).__name__}: {e}") from e
                vectors = []
                for v in model(part.column("text").to_pylist()):
                    if len(v) != encoder.dimensions:
                        raise DependencyError(f"the encoder {encoder.name} gave {len(v)} numbers, not {encoder.dimensions}")
                    length = math.sqrt(sum(float(x) * float(x) for x in v)) or 1.0
                    vectors.append([float(x) / length for x in v])
                yield pa.RecordBatch.from_arrays([part.column("name"), part.column("text"), part.column("hash"), pa.array(vectors, pa.list_(pa.float64()))], names=["name", "text", "hash", "vector"])

    return rows.select("name", "text", "hash").mapInArrow(encode, "name string, text string, hash string, vector array<double>")


def sidecar(g: Graph, fields: Sequence[str], encoder: Encoder, before: DataFrame | None = None) -> DataFrame:
    """The whole sidecar: fresh vectors and those of ``before`` that still hold, in order of name."""
    stale, kept = to_encode(texts(g, fields), before, encoder.name, fields_hash(fields))
    rows = encoded(stale, encoder)
    if kept is not None:
        rows = rows.unionByName(kept)
    return rows.select("name", "text", "hash", "vector", F.lit(encoder.name).alias("model"), F.lit(encoder.dimensions).alias("dimensions"), F.array(*map(F.lit, fields)).alias("fields"), F.lit(fields_hash(fields)).alias("fields_hash"), F.lit(SCHEMA_VERSION).alias("schema_version")).orderBy("name")


def write(rows: DataFrame, path: str) -> None:
    """Sorted by name, so an unchanged graph gives the same rows in the same order; staged, for ``before`` may be read from it."""
    sinks.replace(rows, path)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored sidecar; none where there is none, or one of another form: it can always be made anew."""
    if not sinks.exists(spark, path):
        return None
    try:
        rows = spark.read.parquet(path)
        rows = rows.select(*(F.col(c.split()[0]) for c in SIDECAR.split(", ")))
    except Exception:  # noqa: BLE001  (whatever is wrong with it, it counts as missing)
        return None
    return None if rows.where(F.col("schema_version") != SCHEMA_VERSION).limit(1).count() else rows


def attached(concepts: DataFrame, rows: DataFrame) -> DataFrame:
    """Concepts with their vectors, null without one."""
    return concepts.join(rows.select("name", F.col("vector").alias("embedding")), "name", "left")
