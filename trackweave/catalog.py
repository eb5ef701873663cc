"""All queries of the engine by name, with their SQL counterparts."""

from __future__ import annotations

from .queries import outputs, points, topology

_MODULES = (topology, points, outputs)
QUERIES: dict = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
FLAGSHIP = "edge_points"
