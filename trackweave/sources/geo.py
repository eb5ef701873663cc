"""Reading geometry: GeoJSON text, GeoJSON sequences, WKB in (Geo)Parquet and national source tables."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import LINE

#: Schema of a line of a GeoJSON sequence: geometry stays text, properties become a map.
GEOJSON = "type string, geometry string, properties map<string,string>"
_XYZ = "p -> named_struct('x', get(p, 0), 'y', get(p, 1), 'z', coalesce(get(p, 2), double('NaN')))"


def geojson_line(column: str) -> Column:
    """LineString text as a line; other types are null."""
    parsed = f"from_json({column}, 'type string, coordinates array<array<double>>')"
    return F.expr(f"CASE WHEN get_json_object({column}, '$.type') = 'LineString' THEN transform({parsed}.coordinates, {_XYZ}) END")


def geojson_lines(column: str) -> Column:
    """MultiLineString (or LineString) text as an array of lines."""
    parsed = f"from_json({column}, 'coordinates array<array<array<double>>>')"
    return F.expr(f"CASE WHEN get_json_object({column}, '$.type') = 'MultiLineString' THEN transform({parsed}.coordinates, l -> transform(l, {_XYZ})) END")


def read_geojson_sequence(spark: SparkSession, path: str) -> DataFrame:
    """One feature per line; a malformed line fails the job."""
    return spark.read.schema(GEOJSON).option("mode", "FAILFAST").option("multiLine", False).json(path)


def _geometry(data: bytes, at: int) -> tuple[list[list[tuple[float, float, float]]], int]:
    order = "<" if data[at] == 1 else ">"
    kind = struct.unpack_from(order + "I", data, at + 1)[0]
    at += 5
    if kind & 0x20000000:  # an SRID follows
        at += 4
    has_z, has_m = bool(kind & 0x80000000), bool(kind & 0x40000000)
    base = kind & 0xFFFF
    has_z, has_m, base = has_z or base // 1000 in (1, 3), has_m or base // 1000 in (2, 3), base % 1000
    width = 2 + has_z + has_m

    def coordinates(n: int, at: int) -> tuple[list[tuple[float, float, float]], int]:
        flat = struct.unpack_from(f"{order}{n * width}d", data, at)
        rows = [flat[i : i + width] for i in range(0, len(flat), width)]
        return [(r[0], r[1], r[2] if has_z else float("nan")) for r in rows], at + 8 * n * width

    if base == 1:
        points, at = coordinates(1, at)
        return [points], at
    n = struct.unpack_from(order + "I", data, at)[0]
    at += 4
    if base == 2:
        points, at = coordinates(n, at)
        return [points], at
    if base not in (4, 5, 7):
        raise ValueError(f"geometry type {base} is not supported")
    parts = []
    for _ in range(n):
        more, at = _geometry(data, at)
        parts += more
    return parts, at


def decode_wkb(data: bytes | None) -> list[list[tuple[float, float, float]]] | None:
    """Points, lines and their collections as lists of vertices (ISO and extended WKB)."""
    return None if data is None else _geometry(bytes(data), 0)[0]


def encode_wkb(lines: list[list[tuple[float, float, float]]]) -> bytes:
    """A LineString, or a MultiLineString of several lines, with Z where all vertices have one."""
    z = all(v[2] == v[2] for line in lines for v in line)

    def one(line: list) -> bytes:
        return struct.pack("<BII", 1, 1002 if z else 2, len(line)) + b"".join(struct.pack("<3d" if z else "<2d", *v[: 3 if z else 2]) for v in line)

    return one(lines[0]) if len(lines) == 1 else struct.pack("<BII", 1, 1005 if z else 5, len(lines)) + b"".join(map(one, lines))


def with_lines(df: DataFrame, column: str = "geometry") -> DataFrame:
    """`df` with `lines` (array of lines) decoded from a WKB column."""

    @F.arrow_udf(f"array<{LINE}>")
    def lines(wkb: pa.Array) -> pa.Array:
        kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())])))
        named = lambda v: dict(zip("xyz", v, strict=True))
        return pa.array([None if x is None else [[named(v) for v in line] for line in x] for x in map(decode_wkb, wkb.to_pylist())], kind)

    return df.withColumn("lines", lines(F.col(column)))


def read_geoparquet(spark: SparkSession, path: str, column: str = "geometry") -> DataFrame:
    """GeoParquet with WKB geometry; other columns and filters reach the scan as in any Parquet file."""
    return with_lines(spark.read.parquet(path), column)


def write_geoparquet(df: DataFrame, path: str, line: str = "line", column: str = "geometry", mode: str = "errorifexists") -> None:
    """Lines as WKB in Parquet (the column's metadata names the encoding)."""

    @F.arrow_udf("binary")
    def wkb(lines: pa.Array) -> pa.Array:
        return pa.array([None if x is None else encode_wkb([[(v["x"], v["y"], v["z"] if v["z"] is not None else float("nan")) for v in x]]) for x in lines.to_pylist()], pa.binary())

    df.withColumn(column, wkb(F.col(line))).withMetadata(column, {"encoding": "WKB"}).drop(line).write.mode(mode).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that is read recursively: empty before the first run has written it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
