"""Settings of a run, by target, from one TOML file.

[parquet] needs no entry: target, fulltext_analyzer, and a table [parquet.embeddings] with model and fields.
[html] has the options of what is drawn; a file that cannot be read leaves it at its defaults, since a page needs nothing.
"""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any

from loomgraph.errors import SettingsError
from loomgraph.operators.view import Scope

PARQUET, HTML = "parquet", "html"
BACKENDS = (PARQUET, HTML)
DEFAULT_ANALYZER = "standard"
DEFAULT_ENCODER = "hashed-64"


@dataclass(frozen=True)
class StoreSettings:
    target: str = ""
    fulltext_analyzer: str = DEFAULT_ANALYZER
    embedding_model: str = DEFAULT_ENCODER
    embedding_fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class PageSettings:
    target: str = "graph.html"
    scope: Scope = Scope()


def _parsed(path: str) -> dict[str, Any]:
    try:
        return tomllib.loads(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError:
        raise SettingsError("no such settings file", details=path) from None
    except (OSError, UnicodeDecodeError, tomllib.TOMLDecodeError) as e:
        raise SettingsError("the settings cannot be read", details=str(e)) from None


def _table(value: Any, name: str) -> dict[str, Any]:
    if not isinstance(value, dict):
        raise SettingsError(f"[{name}] must be a table")
    return value


def _names(value: Any, name: str) -> tuple[str, ...]:
    """A list of names; a single string is one name."""
    if isinstance(value, str):
        value = [value]
    if not isinstance(value, list):
        raise SettingsError(f"{name} must be a list of field names")
    return tuple(map(str, value))


def store(parsed: dict[str, Any]) -> StoreSettings:
    own = _table(parsed.get(PARQUET, {}), PARQUET)
    vectors = _table(own.get("embeddings", {}), f"{PARQUET}.embeddings")
    return StoreSettings(
        target=str(own.get("target") or ""),
        fulltext_analyzer=str(own.get("fulltext_analyzer") or DEFAULT_ANALYZER),
        embedding_model=str(vectors.get("model") or DEFAULT_ENCODER),
        embedding_fields=_names(vectors.get("fields") or [], f"[{PARQUET}.embeddings] fields"),
    )


def page(parsed: dict[str, Any]) -> PageSettings:
    own = _table(parsed.get(HTML, {}), HTML)
    kinds = {f.name: type(f.default) for f in fields(Scope)}
    given = {k: v if v is None or kinds[k] is type(None) else kinds[k](v) for k, v in own.items() if k in kinds}
    return PageSettings(str(own.get("target") or own.get("output_path") or PageSettings.target), Scope(**given))


def load(path: str | None, backend: str) -> StoreSettings | PageSettings:
    """The settings of one target; SettingsError where they cannot be used."""
    if backend not in BACKENDS:
        raise SettingsError(f"unknown target {backend}", details=f"known: {', '.join(BACKENDS)}")
    if backend == HTML:
        try:
            return page(_parsed(path)) if path else PageSettings()
        except (SettingsError, TypeError, ValueError):
            return PageSettings()
    return store(_parsed(path)) if path else StoreSettings()
