"""Mapbox vector tiles: features of a tile as protocol-buffer bytes (public specification 2.1)."""

from __future__ import annotations

import gzip
import math
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTENT = 4096
EARTH = 6378137.0
POINT, LINESTRING = 1, 2


def varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def zigzag(n: int) -> int:
    return (n << 1) ^ (n >> 63)


def _field(number: int, wire: int, payload: bytes) -> bytes:
    return varint(number << 3 | wire) + (varint(len(payload)) + payload if wire == 2 else payload)


def value(v) -> bytes:
    """A Value message."""
    if isinstance(v, bool):
        return _field(7, 0, varint(int(v)))
    if isinstance(v, int):
        return _field(4, 0, varint(v)) if v >= 0 else _field(6, 0, varint(zigzag(v)))
    if isinstance(v, float):
        return _field(3, 1, struct.pack("<d", v))
    return _field(1, 2, str(v).encode())


def geometry(points: list[tuple[int, int]]) -> tuple[int, list[int]]:
    """Type and commands of a point (one vertex) or a line."""
    x, y = points[0]
    commands = [1 | 1 << 3, zigzag(x), zigzag(y)]
    if len(points) == 1:
        return POINT, commands
    commands.append(2 | len(points) - 1 << 3)
    for (a, b), (c, d) in zip(points, points[1:], strict=False):
        commands += [zigzag(c - a), zigzag(d - b)]
    return LINESTRING, commands


def place(lng: float, lat: float, z: int, x: int, y: int) -> tuple[int, int]:
    """Position inside a tile, from its upper left corner."""
    n = 2**z
    fx = (lng + 180) / 360 * n - x
    fy = (1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * n - y
    return round(fx * EXTENT), round(fy * EXTENT)


def encode(features: Iterable[tuple[str, int | None, list[tuple[int, int]], dict]]) -> bytes:
    """A tile of features (layer, id, vertices, attributes); null attributes are left out."""
    layers: dict[str, list] = {}
    for f in features:
        layers.setdefault(f[0], []).append(f[1:])
    out = b""
    for name, rows in sorted(layers.items()):
        keys: dict[str, int] = {}
        values: dict[tuple, int] = {}
        body = _field(15, 0, varint(2)) + _field(1, 2, name.encode())
        for identifier, points, attributes in rows:
            tags = []
            for k, v in attributes.items():
                if v is not None:
                    tags += [keys.setdefault(k, len(keys)), values.setdefault((type(v), v), len(values))]
            kind, commands = geometry(points)
            feature = _field(1, 0, varint(identifier)) if identifier is not None else b""
            feature += _field(2, 2, b"".join(map(varint, tags))) + _field(3, 0, varint(kind)) + _field(4, 2, b"".join(map(varint, commands)))
            body += _field(2, 2, feature)
        body += b"".join(_field(3, 2, k.encode()) for k in keys) + b"".join(_field(4, 2, value(v)) for _, v in values) + _field(5, 0, varint(EXTENT))
        out += _field(3, 2, body)
    return out


def tiles(points: DataFrame, layer: str = "pps", ignore: tuple[str, ...] = (), compress: bool = True) -> DataFrame:
    """z, x, y and data of each tile. points: z_level, tile_x, tile_y, lng, lat, optionally id and layer; all
    other columns become attributes. A tile's features meet in one task, so tiles must be of map size."""
    fixed = {"z_level", "tile_x", "tile_y", "lng", "lat", "id", "layer"}
    attributes = [c for c in points.columns if c not in fixed and c not in ignore]
    has_id, has_layer = "id" in points.columns, "layer" in points.columns
    kinds = {f.name: f.dataType for f in points.schema}
    key = ("z_level", "tile_x", "tile_y")
    order = [c for c in ("id", *attributes) if c in points.columns and not isinstance(kinds[c], T.MapType)]

    def build(rows: pa.Table) -> pa.RecordBatch:
        z, x, y, lng, lat = (rows.column(c).to_numpy() for c in (*key, "lng", "lat"))
        n = np.exp2(z.astype(np.float64))
        px = np.rint(((lng + 180) / 360 * n - x) * EXTENT).astype(np.int64).tolist()
        py = np.rint(((1 - np.arcsinh(np.tan(np.radians(lat))) / np.pi) / 2 * n - y) * EXTENT).astype(np.int64).tolist()
        ids = [i & (1 << 64) - 1 for i in rows.column("id").to_pylist()] if has_id else [None] * len(px)
        layers = rows.column("layer").to_pylist() if has_layer else [layer] * len(px)
        columns = [[None if v != v else v for v in rows.column(c).to_pylist()] for c in attributes]
        cuts = np.flatnonzero(np.concatenate([[True], (np.diff(z) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0), [True]])).tolist()
        data = []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            tile = encode((layers[i], ids[i], [(px[i], py[i])], {c: v[i] for c, v in zip(attributes, columns, strict=True)}) for i in range(lo, hi))
            data.append(gzip.compress(tile, mtime=0) if compress else tile)
        at = cuts[:-1]
        arrays = [pa.array(z[at].astype(np.int32)), pa.array(x[at].astype(np.int64)), pa.array(y[at].astype(np.int64)), pa.array(data, pa.binary()), pa.array(np.diff(cuts))]
        return pa.RecordBatch.from_arrays(arrays, ["z", "x", "y", "data", "n"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            last = np.ones(held.num_rows, dtype=bool)
            for c in key:
                v = held.column(c).to_numpy()
                last &= v == v[-1]
            at = held.num_rows - int(last.sum())  # the last tile may go on in the next batch
            if at:
                yield build(held.slice(0, at))
                held = held.slice(at)
        if held is not None:
            yield build(held)

    kept = points.select(*[c for c in points.columns if c in fixed or c in attributes]).where(F.col("tile_x").isNotNull())
    return kept.repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(scan, "z int, x long, y long, data binary, n long")
