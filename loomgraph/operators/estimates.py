"""How long metrics will take, from the size of the graph and what one of them took here."""

from __future__ import annotations

from collections.abc import Sequence

#: Seconds for 100,000 vertices of the reference graph, the power of the edges each grows with, and that graph's size (fixed
#: values).
SECONDS = {"pagerank": 4.0, "betweenness": 45.0, "community": 232.0}
POWERS = {"pagerank": 1.0, "betweenness": 2.0, "community": 1.1}
VERTICES, EDGES = 275_687, 820_388


def seconds(vertices: int, names: Sequence[str], calibration: float | None = None, edges: int | None = None) -> float:
    """The expected time of the named metrics; without the number of edges the reference graph's density stands in."""
    if vertices <= 0:
        return 0.0
    share = (edges if edges and edges > 0 else vertices * EDGES / VERTICES) / EDGES
    known = [n for n in names if n in SECONDS]
    return sum(SECONDS[n] * VERTICES / 100_000 * share ** POWERS[n] for n in known) * (calibration if calibration and calibration > 0 else 1.0)


def calibration(observed: float, vertices: int, edges: int | None = None) -> float | None:
    """Observed against expected seconds of PageRank, the factor for the other metrics; none where either is missing."""
    expected = seconds(vertices, ["pagerank"], edges=edges)
    return observed / expected if expected > 0 and observed > 0 else None
