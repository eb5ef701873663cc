"""Main lines: tracks of one line joined to long smooth curves, and those bundled to centre lines.

A line's tracks are few (one railway line of one operator), so a group is worked on in one task with
numpy; the groups themselves are spread over the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import uuid3

RASTER = 100.0
HALF_WIDTH = 50.0
TOLERANCE = 100.0
SMOOTH = np.pi / 4
Line = np.ndarray


def length(line: Line) -> float:
    return float(np.hypot(*np.diff(line, axis=0).T).sum())


def _turn(first: Line, second: Line) -> float:
    a, b = first[-1] - first[-2], second[1] - second[0]
    d = np.arctan2(b[1], b[0]) - np.arctan2(a[1], a[0])
    return float(abs((d + np.pi) % (2 * np.pi) - np.pi))


def merge_smooth(lines: list[Line]) -> list[Line]:
    """Curves that start where only one line ends and go on to the straightest unused line at each joint."""
    lines = sorted((x for x in lines if len(x) > 1), key=lambda x: x.tolist())
    both = [(i, x) for i, x in enumerate(lines)] + [(i, x[::-1]) for i, x in enumerate(lines)]
    at: dict[tuple, list[int]] = {}
    for k, (_, x) in enumerate(both):
        at.setdefault(tuple(x[0]), []).append(k)
    used: set[int] = set()
    out = []
    for k, (i, x) in enumerate(both):
        if len(at[tuple(x[0])]) > 1 or i in used:
            continue
        used.add(i)
        curve = x
        while True:
            following = [(_turn(curve, both[n][1]), n) for n in at.get(tuple(curve[-1]), ()) if both[n][0] not in used]
            following = [f for f in following if f[0] < SMOOTH]
            if not following:
                break
            n = min(following)[1]
            used.add(both[n][0])
            curve = np.vstack([curve, both[n][1][1:]])
        out.append(curve)
    return out


def _along(line: Line, where: np.ndarray) -> np.ndarray:
    at = np.concatenate([[0.0], np.cumsum(np.hypot(*np.diff(line, axis=0).T))])
    where = np.clip(where, 0, at[-1])
    return np.column_stack([np.interp(where, at, line[:, 0]), np.interp(where, at, line[:, 1])])


def _crossing(p: np.ndarray, q: np.ndarray, line: Line) -> np.ndarray | None:
    """The first point (along p-q) where the segment p-q meets `line`."""
    a, b = line[:-1], line[1:]
    r, s = q - p, b - a
    cross = r[0] * s[:, 1] - r[1] * s[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = ((a[:, 0] - p[0]) * s[:, 1] - (a[:, 1] - p[1]) * s[:, 0]) / cross
        u = ((a[:, 0] - p[0]) * r[1] - (a[:, 1] - p[1]) * r[0]) / cross
    hit = (cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    return p + t[hit].min() * r if hit.any() else None


def centre_lines(curves: list[Line]) -> list[Line]:
    """The longest curve, moved to the middle of the curves beside it every 100 m; those it has bundled over
    more than half of their length are taken up, and so on with the rest."""
    rest = sorted(curves, key=lambda c: (-length(c), c.tolist()))
    out = []
    while rest:
        main, rest = rest[0], rest[1:]
        total = length(main)
        where = np.append(np.arange(int(total / RASTER) + 1) * RASTER, total)
        points, ahead, behind = _along(main, where), _along(main, where + 1), _along(main, where - 1)
        hits = [0] * len(rest)
        middle = []
        for c, direction in zip(points, ahead - behind, strict=True):
            normal = np.array([-direction[1], direction[0]]) / max(float(np.hypot(*direction)), 1e-12)
            p, q = c - HALF_WIDTH * normal, c + HALF_WIDTH * normal
            found = [c]
            for i, other in enumerate(rest):
                x = _crossing(p, q, other)
                if x is not None:
                    hits[i] += 1
                    found.append(x)
            middle.append(np.mean(found, axis=0))
        out.append(np.array(middle))
        rest = [c for c, n in zip(rest, hits, strict=True) if n <= length(c) / RASTER / 2]
    return out


def simplify(line: Line, tolerance: float = TOLERANCE) -> Line:
    """Visvalingam-Whyatt: vertices whose triangle is smaller than tolerance**2 go, the smallest first."""
    keep = list(range(len(line)))

    def area(i: int) -> float:
        a, b, c = line[keep[i - 1]], line[keep[i]], line[keep[i + 1]]
        return abs((b[0] - a[0]) * (c[1] - a[1]) - (c[0] - a[0]) * (b[1] - a[1])) / 2

    while len(keep) > 2:
        areas = [area(i) for i in range(1, len(keep) - 1)]
        least = int(np.argmin(areas))
        if areas[least] >= tolerance * tolerance:
            break
        del keep[least + 1]
    return line[keep]


def extract(tracks: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """uuid_line, line, operator and lines (centre lines) per line number and operator.

    tracks: ref, operator and line in a metric reference system. A track of several lines (`ref` 1;2) counts
    for each of them.
    """
    each = tracks.select("operator", "line", F.explode(F.split("ref", ";")).alias("number")).select("operator", "line", F.trim("number").alias("number"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lines = [np.array([(p["x"], p["y"]) for p in x]) for x in pdf["line"]]
        made = [simplify(c, tolerance) for c in centre_lines(merge_smooth(lines))]
        named = [[{"x": float(x), "y": float(y), "z": float("nan")} for x, y in m] for m in made]
        return pd.DataFrame({"number": [key[0]], "operator": [key[1]], "lines": [named]})

    out = each.groupBy("number", "operator").applyInPandas(run, "number string, operator string, lines array<array<struct<x:double,y:double,z:double>>>")
    name = F.concat_ws("#", "number", F.coalesce("operator", F.lit("")))
    return out.where(F.size("lines") > 0).select(uuid3(name).alias("uuid_line"), "number", "operator", "lines")
