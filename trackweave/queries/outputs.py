"""Binary outputs and line extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixtures
from ..operators import gold as G
from ..operators import lines as Lines
from ..sinks import flatgeobuf, mvt
from ..sources import geo
from .points import _FAN, _FILTERS, _POINTS, _TILES, _candidates, _lnglat
from .topology import _TRACKS


def vector_tiles(spark, sf_dir: str) -> DataFrame:
    """Encoded tiles of the points of all tracks, with their number of features."""
    c = G.with_tile(G.zoom_fanout(_lnglat(_candidates(spark, sf_dir)), _FILTERS))
    t = mvt.tiles(c.select("z_level", "tile_x", "tile_y", "lng", "lat", "uuid_edge", "edge_idx", "radius", "well_defined"))
    return t.select("z", "x", "y", "n", (F.length("data") > 0).alias("has_data"))


def fgb_features(spark, sf_dir: str) -> DataFrame:
    """Features of a FlatGeobuf file, encoded on the executors."""
    t = fixtures.tracks(spark, sf_dir).select("uuid_track", "k", "tags", F.array("line").alias("lines"))
    features, _ = flatgeobuf.encode(t)
    return features.groupBy(F.length("feature").alias("bytes")).agg(F.count("*").alias("n"))


def wkb_roundtrip(spark, sf_dir: str) -> DataFrame:
    """Lines written as WKB and decoded again: vertices and sums of their coordinates."""

    @F.pandas_udf("binary")
    def wkb(lines):
        return lines.map(lambda x: geo.encode_wkb([[(v["x"], v["y"], v["z"]) for v in x]]))

    t = fixtures.tracks(spark, sf_dir).select("uuid_track", wkb("line").alias("geometry"))
    t = geo.with_lines(t).select("uuid_track", F.explode("lines").alias("l"))
    return t.selectExpr("uuid_track", "size(l) AS n_points", "round(aggregate(l, 0D, (s, p) -> s + p.x + 3 * p.y + 7 * p.z), 6) AS checksum")


def main_line_extract(spark, sf_dir: str) -> DataFrame:
    """Centre lines per line number (25 rows of vertices make one) and track type."""
    t = fixtures.tracks(spark, sf_dir).selectExpr("cast(k div 250 AS string) AS ref", "type AS operator", "line")
    return Lines.extract(t).select("uuid_line", "number", "operator", F.size("lines").alias("n_lines"))


QUERIES = {f.__name__: f for f in (vector_tiles, fgb_features, wkb_roundtrip, main_line_extract)}
ORACLES = {
    "vector_tiles": f"""{_POINTS}{_FAN} SELECT z, x, y, count(*) AS n, true AS has_data FROM (SELECT z, {_TILES} FROM (SELECT level AS z, 5.9::double + points.x / 100000 AS lng, 45.8::double + points.y / 100000 AS lat
      FROM points JOIN fan ON zoom <= most)) GROUP BY z, x, y""",
    "wkb_roundtrip": f"{_TRACKS} SELECT uuid_track, 3 AS n_points, round(ax + 3 * ay + 7 * az + mx + 3 * my + 7 * mz + bx + 3 * \"by\" + 7 * bz, 6) AS checksum FROM tracks",
}
