"""A self-contained HTML page of the drawn graph: bounded view tables as JSON inside a template of its own."""

from __future__ import annotations

import html
import json
from pathlib import Path

from pyspark.sql import DataFrame

from loomgraph.model import Graph
from loomgraph.operators import view

TEMPLATE = """<!doctype html><meta charset="utf-8"><title>{title}</title>
<h1>{title}</h1><p id="stats">{stats}</p><input id="q" placeholder="find"><ul id="found"></ul><table id="edges"></table>
<script>
const NODES = {nodes}, EDGES = {edges}, GROUPS = {groups}, HYPEREDGES = {hyperedges}, EVIDENCE = {evidence};
const names = NODES.map(n => n.name), list = document.getElementById("found");
document.getElementById("q").oninput = e => {{
  const part = e.target.value.toLowerCase();
  list.replaceChildren(...names.filter(n => n.toLowerCase().includes(part)).slice(0, 20).map(n => {{
    const row = document.createElement("li"); row.textContent = n; return row; }}));
}};
</script>
"""

#: Rows of any one table that a page may hold; a browser draws no more, and the driver gathers no more.
PAGE_ROWS = 20_000


class TooLarge(ValueError):
    """The view must be narrowed before it is drawn."""


def _rows(df: DataFrame, what: str) -> list[dict]:
    got = df.limit(PAGE_ROWS + 1).collect()
    if len(got) > PAGE_ROWS:
        raise TooLarge(f"more than {PAGE_ROWS} {what}; use min_frequency, min_source_count or max_nodes")
    return [r.asDict(recursive=True) for r in got]


def _script(value: object) -> str:
    return json.dumps(value, ensure_ascii=False).replace("</", "<\\/")


def rendered(g: Graph, scope: view.Scope) -> str:
    names = view.kept(g, scope)
    nodes = _rows(view.nodes(g, scope).orderBy("name"), "nodes")
    edges = _rows(view.edges(g).orderBy("source", "target"), "edges")
    shown = view.evidence(g).join(names.withColumnRenamed("name", "concept"), "concept", "left_semi").orderBy("concept", "place")
    evidence: dict[str, list[dict]] = {}
    for r in _rows(shown, "evidence rows"):
        evidence.setdefault(r.pop("concept"), []).append(r)
    kept = sum(not n["filtered"] for n in nodes)
    groups = {f: _rows(view.legend(view.groups(g, names, f)).orderBy("cid"), "groups") for f in g.graph_fields}
    return TEMPLATE.format(
        title=html.escape(str(g.context.get("project", "graph"))), stats=f"{kept} nodes, {len(edges)} edges", nodes=_script(nodes), edges=_script(edges),
        groups=_script(groups), hyperedges=_script(_rows(view.hyperedges(g, names, scope.max_hyperedges), "hyperedges")), evidence=_script(evidence),
    )


def write(g: Graph, path: str, scope: view.Scope | None = None) -> None:
    Path(path).write_text(rendered(g, scope or view.Scope()), encoding="utf-8")
