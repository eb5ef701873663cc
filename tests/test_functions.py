"""Geometry, identifiers, reference systems and cells, by hand-made values."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from trackweave.functions import cells, crs, ids
from trackweave.functions import geometry as g

LINE = "line array<struct<x:double,y:double,z:double>>"


def one(spark, expression, **points):
    fields = ", ".join(f"named_struct('x', {p[0]}D, 'y', {p[1]}D, 'z', {p[2] if len(p) > 2 else 0}D) AS {k}" for k, p in points.items())
    return spark.sql(f"SELECT {expression} AS v FROM (SELECT {fields or '1'})").first()["v"]


def test_circumradius(spark):
    r = g.circumradius("a", "b", "c")
    assert one(spark, r, a=(0, 0), b=(0, 1), c=(1, 1)) < 0
    assert one(spark, r, a=(0, 0), b=(0, 1), c=(-1, 1)) == pytest.approx(math.sqrt(0.5))
    assert one(spark, r, a=(0, 0), b=(0, 1), c=(0, 2)) is None
    assert one(spark, r, a=(0, 0), b=(1000, 0.0001), c=(2000, 0)) is None


def test_grade_azimuth_angles(spark):
    assert one(spark, g.grade("a", "b"), a=(0, 0, 1), b=(0, 2, 3)) == pytest.approx(0.001)
    assert one(spark, g.grade("a", "b"), a=(0, 0, 1), b=(0, 0, 3)) is None
    assert one(spark, g.azimuth("a", "b"), a=(0, 0), b=(0, 2)) == pytest.approx(math.pi / 2)
    for x, y in ((3.0, -3.0), (0.1, 6.2), (-9.0, 9.0)):
        want = abs((x - y + math.pi) % (2 * math.pi) - math.pi)
        assert one(spark, g.angle_diff(f"{x}D", f"{y}D")) == pytest.approx(want)


def test_lines(spark):
    df = spark.createDataFrame([([(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (1.0, 1.0, 5.0)],), ([(2.0, 2.0, 0.0)],), ([(0.0, 0.0, 0.0), (0.0, 0.0, 1.0), (3.0, 4.0, 1.0)],)], LINE)
    rows = df.select(g.line_positions("line").alias("m"), g.line_length("line").alias("n"), g.as_wkt("line").alias("w"), F.size(g.without_repeats("line")).alias("k")).collect()
    assert [r["m"] for r in rows] == [[0, 1, 2], [0], [0, 0, 5]]
    assert [r["n"] for r in rows] == [2, 0, 5] and [r["k"] for r in rows] == [3, 1, 2]
    assert rows[0]["w"].startswith("LINESTRING (0.0 0.0, 1.0 0.0")


def test_split_acute(spark):
    df = spark.createDataFrame([([(0.0, 0.0, 0.0), (10.0, 0.0, 0.0), (1.0, 1.0, 0.0), (1.0, 9.0, 0.0)],)], LINE)
    parts = df.select(g.split_acute("line").alias("p")).first()["p"]
    assert [[(v["x"], v["y"]) for v in p] for p in parts] == [[(0, 0), (10, 0)], [(10, 0), (1, 1), (1, 9)]]


def test_uuid_and_token(spark):
    import hashlib

    names = ["", "abc", "Zürich HB"]
    got = spark.createDataFrame([(n,) for n in [*names, None]], "s string").select(ids.uuid3("s").alias("u")).collect()
    assert [r["u"] for r in got] == [str(uuid.UUID(bytes=hashlib.md5(n.encode()).digest(), version=3)) for n in names] + [None]
    import base64

    values = [0, 1, 31, 4095, 1 << 40, (1 << 63) - 1, -1, -(1 << 63)]
    rows = spark.createDataFrame([(v,) for v in values], "id long").select(ids.token("id").alias("t")).collect()
    for v, r in zip(values, rows, strict=True):
        text = base64.b32encode((v % (1 << 64)).to_bytes(8, "big")).decode()[:13].lower()
        assert r["t"] == f"{text[:4]}-{text[4:8]}-{text[8:]}"


def test_point_id_overflow(spark):
    assert spark.sql("SELECT 5L AS c, 4095 AS n").select(ids.point_id("c", "n").alias("i")).first()["i"] == 5 * 4096 + 4095
    with pytest.raises(Exception, match="too many points"):
        spark.sql("SELECT 5L AS c, 4096 AS n").select(ids.point_id("c", "n").alias("i")).collect()


def test_crs(spark):
    lng, lat = crs.transform("EPSG:2056", "EPSG:4326", "e", "n")
    r = spark.sql("SELECT 2600072.37D AS e, 1200147.07D AS n").selectExpr(f"{lng} AS lng", f"{lat} AS lat").first()
    assert r["lng"] == pytest.approx(26782.5 / 3600, abs=2e-5) and r["lat"] == pytest.approx(169028.66 / 3600, abs=2e-5)
    x, y = crs.transform("EPSG:4326", "EPSG:3857", "a", "b")
    r = spark.sql("SELECT 180D AS a, 0D AS b").selectExpr(f"{x} AS x", f"{y} AS y").first()
    assert r["x"] == pytest.approx(20037508.342789244) and r["y"] == pytest.approx(0, abs=1e-6)
    e, n = crs.transform("EPSG:4326", "EPSG:2056", *crs.transform("EPSG:2056", "EPSG:4326", "e", "n"))
    r = spark.sql("SELECT 2700000D AS e, 1100000D AS n").selectExpr(f"{e} AS e", f"{n} AS n").first()
    assert r["e"] == pytest.approx(2700000, abs=1) and r["n"] == pytest.approx(1100000, abs=1)
    with pytest.raises(ValueError):
        crs.srid("2056")
    with pytest.raises(ValueError):
        crs.transform("EPSG:1", "EPSG:4326", "x", "y")


def test_cells(spark):
    r = spark.sql("SELECT 5.0D AS x, -3.0D AS y").select(F.expr(cells.cell("x", "y")).alias("c"), cells.ring("x", "y").alias("ring")).first()
    assert len(set(r["ring"])) == 9 and r["c"] in r["ring"]
    colours = spark.createDataFrame([(c,) for c in r["ring"]], "c long").select(cells.colour("c").alias("k")).collect()
    assert {x["k"] for x in colours} == {0, 1, 2, 3}
