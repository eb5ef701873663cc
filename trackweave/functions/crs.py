"""Coordinate reference systems as closed-form column expressions (longitude before latitude).

EPSG:3857 is exact. EPSG:2056 uses the approximate formulas that the Swiss survey publishes (accurate to
about a metre over the country).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH = 6378137.0


def srid(crs: str) -> int:
    m = re.fullmatch(r"EPSG:(\d+)", crs)
    if not m:
        raise ValueError(f"not a reference system like EPSG:2056: {crs}")
    return int(m[1])


def to_3857(lng: str, lat: str) -> tuple[str, str]:
    return f"(radians({lng}) * {EARTH})", f"(ln(tan(pi() / 4 + radians({lat}) / 2)) * {EARTH})"


def from_3857(x: str, y: str) -> tuple[str, str]:
    return f"degrees({x} / {EARTH})", f"degrees(2 * atan(exp({y} / {EARTH})) - pi() / 2)"


def from_2056(e: str, n: str) -> tuple[str, str]:
    y, x = f"(({e} - 2600000) / 1000000)", f"(({n} - 1200000) / 1000000)"
    lng = f"(2.6779094 + 4.728982 * {y} + 0.791484 * {y} * {x} + 0.1306 * {y} * {x} * {x} - 0.0436 * {y} * {y} * {y})"
    lat = f"(16.9023892 + 3.238272 * {x} - 0.270978 * {y} * {y} - 0.002528 * {x} * {x} - 0.0447 * {y} * {y} * {x} - 0.0140 * {x} * {x} * {x})"
    return f"({lng} * 100 / 36)", f"({lat} * 100 / 36)"


def to_2056(lng: str, lat: str) -> tuple[str, str]:
    p, q = f"(({lat} * 3600 - 169028.66) / 10000)", f"(({lng} * 3600 - 26782.5) / 10000)"
    e = f"(2600072.37 + 211455.93 * {q} - 10938.51 * {q} * {p} - 0.36 * {q} * {p} * {p} - 44.54 * {q} * {q} * {q})"
    n = f"(1200147.07 + 308807.95 * {p} + 3745.25 * {q} * {q} + 76.63 * {p} * {p} - 194.56 * {q} * {q} * {p} + 119.79 * {p} * {p} * {p})"
    return e, n


_TO_4326 = {4326: lambda x, y: (x, y), 3857: from_3857, 2056: from_2056}
_FROM_4326 = {4326: lambda x, y: (x, y), 3857: to_3857, 2056: to_2056}


def transform(source: str, target: str, x: str, y: str) -> tuple[str, str]:
    """SQL text of the coordinates (x, y) of `source` in `target`; decimal constants are read as doubles."""
    a, b = srid(source), srid(target)
    for code in (a, b):
        if code not in _TO_4326:
            raise ValueError(f"EPSG:{code} is not supported")
    out = (x, y) if a == b else _FROM_4326[b](*_TO_4326[a](x, y))
    return tuple(re.sub(r"(?<![\w.])(\d+\.\d+)(?![\w.])", r"\1D", t) for t in out)


def transform_line(source: str, target: str, line: str) -> Column:
    """A whole line in another reference system."""
    x, y = transform(source, target, "p.x", "p.y")
    return F.expr(f"transform({line}, p -> named_struct('x', {x}, 'y', {y}, 'z', p.z))")


def tile(zoom: str, lng: str, lat: str) -> tuple[Column, Column]:
    """Column and row of the web-map tile that holds a point."""
    x = F.expr(f"cast(floor(({lng} + 180) / 360 * power(2, {zoom})) AS bigint)")
    y = F.expr(f"cast(floor((1 - ln(tan(radians({lat})) + 1 / cos(radians({lat}))) / pi()) / 2 * power(2, {zoom})) AS bigint)")
    return x, y
