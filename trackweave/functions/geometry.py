"""Geometry as plain columns: a line is array<struct<x,y,z>>, a point its coordinates.

All functions build Catalyst expressions (no UDF). Lengths and distances are two-dimensional; an absent
height is NaN or null. Angles are radians, counted from the x axis against the clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE = "array<struct<x:double,y:double,z:double>>"
#: Radii beyond this count as straight.
MAX_RADIUS = 100_000
ACUTE = "pi() / 3"
EXTENSION = "pi() / 4"


def distance(a: str, b: str) -> str:
    return f"sqrt(({b}.x - {a}.x) * ({b}.x - {a}.x) + ({b}.y - {a}.y) * ({b}.y - {a}.y))"


def azimuth(a: str, b: str) -> str:
    return f"atan2({b}.y - {a}.y, {b}.x - {a}.x)"


def normalize(angle: str) -> str:
    """The same direction in (-pi, pi]."""
    return f"(({angle}) - 2 * pi() * ceil((({angle}) - pi()) / (2 * pi())))"


def angle_diff(a: str, b: str) -> str:
    """Smallest angle between two directions, 0 to pi."""
    return f"abs({normalize(f'({a}) - ({b})')})"


def circumradius(a: str, b: str, c: str) -> str:
    """Signed radius of the circle through three points (left turns are positive); null on a straight line."""
    area = f"(({b}.x - {a}.x) * ({c}.y - {a}.y) - ({c}.x - {a}.x) * ({b}.y - {a}.y)) / 2"
    radius = f"({distance(a, b)} * {distance(b, c)} * {distance(c, a)} / nullif(4 * ({area}), 0))"
    return f"(CASE WHEN abs({radius}) <= {MAX_RADIUS} THEN {radius} END)"


def grade(a: str, b: str) -> str:
    """Rise over run, divided by 1000; null between points of one place or without height."""
    run = distance(a, b)
    return f"(CASE WHEN NOT isnan({a}.z) AND NOT isnan({b}.z) THEN ({b}.z - {a}.z) / nullif({run}, 0) / 1000 END)"


def round5(value: str) -> str:
    return f"(floor(({value}) * 100000 + 0.5D) / 100000D)"


def line_length(line: str) -> Column:
    return F.expr(f"aggregate(sequence(1, greatest(size({line}) - 1, 1)), 0D, (s, i) -> s + coalesce({distance(f'get({line}, i - 1)', f'get({line}, i)')}, 0D))")


def line_positions(line: str) -> Column:
    """Running length at each vertex (the M ordinate)."""
    step = distance(f"element_at({line}, i)", f"element_at({line}, i + 1)")
    return F.expr(f"CASE WHEN size({line}) < 2 THEN transform({line}, p -> 0D) ELSE aggregate(sequence(1, size({line}) - 1), array(0D), (m, i) -> array_append(m, element_at(m, -1) + {step})) END")


def without_repeats(line: str) -> Column:
    """Vertices that equal their predecessor in x and y left out."""
    return F.expr(f"filter({line}, (p, i) -> i = 0 OR get({line}, i - 1).x <> p.x OR get({line}, i - 1).y <> p.y)")


def reverse(line: str) -> Column:
    return F.reverse(F.col(line))


def merge_lines(first: str, second: str) -> Column:
    """Two lines that meet at the end of the first one."""
    return F.expr(f"concat({first}, slice({second}, 2, greatest(size({second}) - 1, 0)))")


def force_2d(line: str) -> Column:
    return F.expr(f"transform({line}, p -> named_struct('x', p.x, 'y', p.y))")


def split_acute(line: str, max_angle: str = ACUTE) -> Column:
    """Parts of a line, cut at vertices whose interior angle is at most `max_angle`."""
    inner = angle_diff(azimuth(f"get({line}, i)", f"get({line}, i - 1)"), azimuth(f"get({line}, i)", f"get({line}, i + 1)"))
    cuts = f"filter(sequence(0, size({line}) - 1), i -> i > 0 AND i < size({line}) - 1 AND {inner} <= {max_angle})"
    ends = f"concat({cuts}, array(size({line}) - 1))"
    starts = f"concat(array(0), {cuts})"
    return F.expr(f"CASE WHEN size({line}) < 3 THEN array({line}) ELSE zip_with({starts}, {ends}, (a, b) -> slice({line}, a + 1, b - a + 1)) END")


def as_wkt(line: str) -> Column:
    return F.expr(f"concat('LINESTRING (', array_join(transform({line}, p -> concat(cast(p.x AS string), ' ', cast(p.y AS string))), ', '), ')')")


def is_extension(last_a: str, last_b: str, first_a: str, first_b: str) -> str:
    """Does a line that starts with (first_a, first_b) go on in the direction of (last_a, last_b)?"""
    return f"({angle_diff(azimuth(last_a, last_b), azimuth(first_a, first_b))} < {EXTENSION})"
