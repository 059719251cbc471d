"""Scalar functions as column expressions; only Unicode normalisation needs Python."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def squeezed(x: Column) -> Column:
    """White-space runs as one space, trimmed."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


@F.pandas_udf(T.StringType())
def nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFC", v))


def identity(x: Column) -> Column:
    """The identity of a concept's name: composed form, case and white space folded; _ and - differ.  For distinct names."""
    return F.lower(squeezed(nfc(x)))


def humanized(x: Column) -> Column:
    return F.translate(x, "_", " ")


def capitalized(x: Column) -> Column:
    """First letter in upper case, the rest in lower case."""
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))


def label(x: Column) -> Column:
    """A node label: letters, digits and underscores stay; a leading digit gets an underscore; empty is Unknown."""
    kept = F.regexp_replace(x, r"[^\p{L}\p{N}_]", "")
    return F.when(kept == "", "Unknown").when(kept.rlike(r"^\p{N}"), F.concat(F.lit("_"), kept)).otherwise(kept)


def database_name(x: Column, bad: str = "", prefix: str = "db", default: str = "graph") -> Column:
    """A database name: underscores as hyphens, other marks dropped, in lower case, beginning with a letter."""
    kept = F.lower(F.regexp_replace(F.translate(x, "_", "-"), r"[^A-Za-z0-9.\-]", bad))
    return F.when(kept == "", default).when(kept.rlike("^[a-z]"), kept).otherwise(F.concat(F.lit(prefix), kept))


def valid_label(x: Column) -> Column:
    return x.rlike(r"^[A-Za-z_][A-Za-z0-9_]*$")


def entity_label(x: Column) -> Column:
    """Parts between _ and -, each with its first letter in upper case and the rest as it is."""
    parts = F.filter(F.split(x, "[_-]"), lambda p: p != "")
    return label(F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), ""))


def slug(x: Column) -> Column:
    kept = F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(kept == "", "node").otherwise(kept)


def relation_type(x: Column) -> Column:
    return F.upper(F.translate(F.trim(x), " -", "__"))


def shortened(x: Column, limit: int = 60) -> Column:
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit - 3), F.lit("..."))).otherwise(x)


def block_of(item_id: Column) -> Column:
    """The annotated block an item came from; items of other names are their own."""
    found = F.regexp_extract(item_id, r"^(.+)_[nc]\d{4}$", 1)
    return F.when(found == "", item_id).otherwise(found)


def note_field(note: Column, name: str) -> Column:
    """The value of name="..." inside a note, trimmed; empty without one."""
    return F.trim(F.regexp_extract(note, rf'{name}="([^"]*)"', 1))


def relation_color(x: Column, colors: list[str]) -> Column:
    """A colour by the name's checksum, so it is the same in every run."""
    return F.element_at(F.array(*map(F.lit, colors)), (F.pmod(F.crc32(x.cast("binary")), F.lit(len(colors))) + 1).cast("int"))


def text_hash(x: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(x, 256))


def index_label(index: Column, labels: Column) -> Column:
    """The label of an integer index, 0 included; the number itself where the map has none."""
    return F.coalesce(F.try_element_at(labels, index), index.cast("string"))


def concept_text(parts: list[Column]) -> Column:
    """Non-empty parts without trailing dots, joined by '. '."""
    clean = F.transform(F.array(*parts), lambda p: F.regexp_replace(squeezed(p), r"\.+$", ""))
    return F.array_join(F.filter(clean, lambda p: p.isNotNull() & (p != "")), ". ")


def relative_path(path: Column, root: str) -> Column:
    """The path below the root, by whole components; null for others."""
    base = root.rstrip("/") + "/"
    slashed = F.translate(path, "\\", "/")
    return F.when(F.startswith(slashed, F.lit(base)), F.substr(slashed, F.lit(len(base) + 1)))
