"""Property-graph analytics over annotated corpora, planned by Catalyst.

Names for callers: ``Graph``, ``load`` (an exported project), ``run`` (store or draw projects), ``Result``, ``BACKENDS``, and
the errors that a run returns.
"""

from __future__ import annotations

import importlib
from typing import Any

__version__ = "0.2.0"

_NAMES = {
    "Graph": "loomgraph.model", "load": "loomgraph.sources.project_json", "run": "loomgraph.plans.run", "Result": "loomgraph.plans.run",
    "BACKENDS": "loomgraph.plans.settings", "PARQUET": "loomgraph.plans.settings", "HTML": "loomgraph.plans.settings",
    "PipelineError": "loomgraph.errors", "CompilationError": "loomgraph.errors", "SettingsError": "loomgraph.errors", "StoreError": "loomgraph.errors", "DependencyError": "loomgraph.errors",
}
__all__ = sorted(_NAMES)


def __getattr__(name: str) -> Any:
    if name in _NAMES:
        return getattr(importlib.import_module(_NAMES[name]), name)
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
