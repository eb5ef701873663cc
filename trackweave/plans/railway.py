"""The railway pipelines: national topographic tracks, network register and map extract, each from its source to edges, nodes, candidates, position points and published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from ..functions import crs
from ..operators import edges as E
from ..operators import gold as G
from ..operators import loads as L
from ..operators import nodes as N
from ..operators import points as P
from ..operators import snap as S
from .actions import Action, Pipeline, Table


@dataclass(frozen=True)
class Settings:
    """Parameters of one country."""

    root: str
    crs: str = "EPSG:2056"
    interval: float = P.INTERVAL
    snap_radius: float = S.RADIUS
    height_tolerance: float = S.HEIGHT_TOLERANCE
    excluded_tracks: tuple[str, ...] = ()
    web_filter: str = "true"


def _topology(name: str, settings: Settings, standard) -> list[Action]:
    track, edge, node, pp = f"slv-{name}-track", f"slv-{name}-edge", f"slv-{name}-node", f"slv-{name}-pp"
    return [
        Action(f"create-{edge}", (track,), (edge,), (lambda f: {edge: E.merge_edges(standard(f[track]), settings.excluded_tracks)},), name),
        Action(f"create-{node}", (edge,), (node,), (lambda f: {node: N.nodes(f[edge])},), name),
        Action(f"create-{pp}", (edge, node), (pp,), (lambda f: {pp: P.candidates(f[edge], N.zones(f[node]), settings.interval)},), name),
    ]


def _snap(name: str, settings: Settings) -> Action:
    source = f"slv-{name}-pp"

    def step(f):
        known = f["slv-pp"].select("id_positionpoint", F.col("zoom").cast("int").alias("zoom"), "cell", "x", "y", F.col("z").cast("double").alias("z"), F.col("azimuth").cast("double").alias("azimuth"))
        snapped = E.cut(S.snap(f[source], known, settings.snap_radius, settings.height_tolerance), "snapped")
        return {"slv-pp": S.points(snapped, settings.crs), "slv-pp-mapping": S.mapping(snapped)}

    return Action("create-pp", (source,), ("slv-pp", "slv-pp-mapping"), (step,), "pp", recursive=("slv-pp",))


def _gold(name: str, settings: Settings) -> list[Action]:
    edge, pp = f"slv-{name}-edge", f"slv-{name}-pp"

    def web(f):
        return {"gld-edge": f[edge].withColumn("line", crs.transform_line(settings.crs, "EPSG:4326", "line"))}

    def points(f):
        return {"gld-pp": G.gold_points(f["slv-pp"], f["slv-pp-mapping"], f[pp]).where(settings.web_filter)}

    return [Action("load-gld-edge", (edge,), ("gld-edge",), (web,), "gold"), Action("load-gld-pp", ("slv-pp", "slv-pp-mapping", pp), ("gld-pp",), (points,), "gold")]


PP_SCHEMA = "id_positionpoint long, zoom short, cell long, x double, y double, z float, lng double, lat double, azimuth float, token string"


def pipeline(settings: Settings, name: str = "topo", standard=L.topo_tracks) -> Pipeline:
    """Actions of the feeds `name` (edges, nodes, candidates), `pp` (snapping) and `gold` over tables under settings.root."""
    names = [f"slv-{name}-{x}" for x in ("track", "edge", "node", "pp")] + ["slv-pp-mapping", "gld-edge", "gld-pp"]
    tables = {n: Table(n, f"{settings.root}/{n}") for n in names}
    tables["slv-pp"] = Table("slv-pp", f"{settings.root}/slv-pp", mode="append", schema=PP_SCHEMA)
    return Pipeline(tables, [*_topology(name, settings, standard), _snap(name, settings), *_gold(name, settings)])
