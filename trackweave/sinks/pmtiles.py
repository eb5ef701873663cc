"""PMTiles archives, version 3 (public specification): one file of tiles in Hilbert order.

Tiles are sorted by Spark and streamed partition by partition; the driver holds the directory (a few
bytes a tile) and one partition's tiles, never the archive.
"""

from __future__ import annotations

import gzip
import json
import os
import shutil
import struct
import tempfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .mvt import varint

ROOT_BYTES = 16384 - 127
LEAF = 4096


def tile_id(z: int, x: int, y: int) -> int:
    """Position of a tile on the Hilbert curve, after all tiles of lower zoom levels."""
    base = ((1 << 2 * z) - 1) // 3
    d, s = 0, 1 << z >> 1
    while s:
        rx, ry = int(x & s > 0), int(y & s > 0)
        d += s * s * (3 * rx ^ ry)
        if not ry:
            if rx:
                x, y = s - 1 - (x & s - 1), s - 1 - (y & s - 1)
            x, y = y, x
        x, y = x & s - 1, y & s - 1
        s >>= 1
    return base + d


@F.pandas_udf(T.LongType())
def tile_ids(z: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([tile_id(int(a), int(b), int(c)) for a, b, c in zip(z, x, y, strict=True)], dtype="int64")


def directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """Serialised entries (tile id, offset, length, run length)."""
    out, last = varint(len(entries)), 0
    for t, *_ in entries:
        out += varint(t - last)
        last = t
    out += b"".join(varint(e[3]) for e in entries) + b"".join(varint(e[2]) for e in entries)
    for i, (_, offset, _, _) in enumerate(entries):
        out += varint(0 if i and offset == entries[i - 1][1] + entries[i - 1][2] else offset + 1)
    return gzip.compress(out, mtime=0)


def _directories(entries: list[tuple[int, int, int, int]]) -> tuple[bytes, bytes]:
    root = directory(entries)
    if len(root) <= ROOT_BYTES:
        return root, b""
    size = LEAF
    while True:
        leaves, pointers = b"", []
        for i in range(0, len(entries), size):
            leaf = directory(entries[i : i + size])
            pointers.append((entries[i][0], len(leaves), len(leaf), 0))
            leaves += leaf
        root = directory(pointers)
        if len(root) <= ROOT_BYTES:
            return root, leaves
        size *= 2


def write(tiles: DataFrame, path: str, fields: dict[str, str], layer: str = "pps", compressed: bool = True, bounds: tuple[float, float, float, float] = (-180.0, -85.0, 180.0, 85.0)) -> int:
    """Write `tiles` (z, x, y, data) to `path` (any file system that Spark knows); the number of tiles."""
    ordered = tiles.select(tile_ids("z", "x", "y").alias("t"), "z", "data").orderBy("t")
    entries: list[tuple[int, int, int, int]] = []
    low, high, at = 99, 0, 0
    with tempfile.NamedTemporaryFile(delete=False) as body:
        for r in ordered.toLocalIterator(prefetchPartitions=True):
            data = bytes(r["data"])
            body.write(data)
            entries.append((r["t"], at, len(data), 1))
            at += len(data)
            low, high = min(low, r["z"]), max(high, r["z"])
    low = min(low, high)
    root, leaves = _directories(entries)
    vector = [{"id": layer, "fields": fields, "minzoom": low, "maxzoom": high}]
    meta = gzip.compress(json.dumps({"vector_layers": vector}, sort_keys=True).encode(), mtime=0)
    root_at = 127
    meta_at = root_at + len(root)
    leaves_at = meta_at + len(meta)
    data_at = leaves_at + len(leaves)
    n = len(entries)
    west, south, east, north = (round(v * 1e7) for v in bounds)
    header = b"PMTiles\x03" + struct.pack("<11Q", root_at, len(root), meta_at, len(meta), leaves_at, len(leaves), data_at, at, n, n, n)
    header += struct.pack("<6B", 1, 2, 2 if compressed else 1, 1, low, high) + struct.pack("<4i", west, south, east, north) + struct.pack("<B2i", low, (west + east) // 2, (south + north) // 2)
    out = body.name + ".pmtiles"
    with open(out, "wb") as f, open(body.name, "rb") as tail:
        f.write(header + root + meta + leaves)
        shutil.copyfileobj(tail, f)
    os.unlink(body.name)
    publish(tiles.sparkSession, out, path)
    return n


def publish(spark, local: str, path: str) -> None:
    """Move a file of the driver to a file system that Spark knows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).copyFromLocalFile(True, True, jvm.org.apache.hadoop.fs.Path(f"file://{local}"), target)
