"""Edges, nodes, points, snapping, lines and published tables, by hand-made fixtures."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackweave import fixtures
from trackweave.operators import edges as E
from trackweave.operators import gold as G
from trackweave.operators import lines as L
from trackweave.operators import nodes as N
from trackweave.operators import points as P
from trackweave.operators import snap as S

SF = "/root/testdata/sf0.001"
LINE = "line array<struct<x:double,y:double,z:double>>"
CANDIDATE = "uuid_edge string, edge_idx int, position double, prio int, zoom int, x double, y double, z double, azimuth double"


def points_of(spark, vertices, **kw):
    df = spark.createDataFrame([("e", [tuple(map(float, v)) for v in vertices])], f"id string, {LINE}")
    return P.edge_points(df, ["id"], **kw).orderBy("edge_idx").collect()


def test_points_on_a_line(spark):
    rows = points_of(spark, [(0, 0, 100), (0, 0.7, 100), (0, 1.3, 100), (0, 2.05, 100)])
    assert [r["y"] for r in rows] == pytest.approx([0.15 + 0.25 * i for i in range(8)])
    assert [r["zoom"] for r in rows] == [1, 3, 3, 3, 2, 3, 3, 0]
    assert all(r["radius"] is None and r["grade"] == 0 and r["azimuth"] == pytest.approx(math.pi / 2) for r in rows)


def test_points_on_a_square(spark):
    rows = points_of(spark, [(0, -0.5, 100), (0.5, -0.5, 100), (0.5, 0.5, 110), (-0.5, 0.5, 100), (-0.5, -0.5, 100), (0, -0.5, 100)])
    assert len(rows) == 16 and {r["radius"] for r in rows} <= {1, None}
    assert max(r["grade"] for r in rows) == pytest.approx(0.01) and min(r["grade"] for r in rows) == pytest.approx(-0.01)


def test_points_without_height_and_short_edges(spark):
    nan = float("nan")
    rows = points_of(spark, [(0, 0, nan), (30, 0, nan), (60, 10, nan)])
    assert len(rows) == int((30 + math.hypot(30, 10)) / 0.25) and all(r["grade"] is None and not r["well_defined"] for r in rows)
    assert points_of(spark, [(0, 0, 0), (0.1, 0, 0)]) == []
    (only,) = points_of(spark, [(0, 0, 0), (0, 0.3, 0)])
    assert only["zoom"] == 0 and only["azimuth"] == pytest.approx(math.pi / 2)
    assert points_of(spark, [(0, 0, 0)]) == [] and points_of(spark, [(1, 1, 0), (1, 1, 0)]) == []


def track(name, *vertices, tags=("c",)):
    return (name, [tuple(map(float, (*v, 0)[:3])) for v in vertices], list(tags))


def edges_of(spark, rows, excluded=()):
    df = spark.createDataFrame(rows, f"uuid_track string, {LINE}, tags array<string>")
    return sorted((tuple((t["uuid_track"], t["direction"], t["position_from"], t["position_to"]) for t in e["tracks"]), len(e["line"])) for e in E.merge_edges(df, excluded).collect())


def test_merge(spark):
    a, b, c = track("a", (0, 0), (1, 0)), track("b", (2, 0), (1, 0)), track("c", (2, 0), (3, 0))
    assert edges_of(spark, [a, b, c]) == [((("a", 1, 0, 1), ("b", -1, 1, 2), ("c", 1, 2, 3)), 4)]
    changed = track("b", (2, 0), (1, 0), tags=("c", "bridge"))
    assert len(edges_of(spark, [a, changed, c])) == 3
    assert len(edges_of(spark, [a, b, c], ("b",))) == 3
    assert len(edges_of(spark, [a, b, c, track("d", (1, 0), (1, 5))])) == 3


def test_merge_long_chain_and_ring(spark):
    chain = [track(f"t{i:03}", (i, 0), (i + 1, 0)) for i in range(100)]
    ((tracks, n),) = edges_of(spark, chain)
    assert [t[0] for t in tracks] == [f"t{i:03}" for i in range(100)] and n == 101
    corners = [(0, 0), (9, 0), (9, 9), (0, 9)]
    ring = [track(f"r{i}", corners[i], corners[(i + 1) % 4]) for i in range(4)]
    assert [len(t) for t, _ in edges_of(spark, ring)] == [2, 2]
    loop = spark.createDataFrame([track("l", (0, 0), (5, 5), (0, 0))], f"uuid_track string, {LINE}, tags array<string>")
    with pytest.raises(Exception, match="circular edge"):
        E.assert_no_loops(E.merge_edges(loop)).collect()


def switch(spark, *legs):
    rows = [(f"e{i}", [(0.0, 0.0, 0.0), (float(x), float(y), 0.0)] if n is None else [(0.0, 0.0, 0.0), (float(x), float(y), 0.0), (n * x, n * y, 0.0)], f"far{i}", "hub", ["c"]) for i, (x, y, n) in enumerate(legs)]
    df = spark.createDataFrame(rows, f"uuid_edge string, {LINE}, uuid_node_to string, uuid_node_from string, tags array<string>")
    return N.nodes(df).where("uuid_node = 'hub'").first()


def test_simple_switches(spark):
    for legs, sub, radius in (([(1, 0), (1, 1)], "L", 1), ([(1, -0.5), (1, 0.55)], "RL", 2), ([(1, -0.5), (1, -1.5)], "RR", 1)):
        n = switch(spark, (-1, 0, 25.0), *[(x, y, 30 / math.hypot(x, y)) for x, y in legs])
        assert (n["switch_type"]["tpe"], n["switch_type"]["sub_tpe"], n["switch_type"]["radius"]) == ("SS", sub, radius)
        main = [e for e in n["edges"] if e["main_edge"]]
        assert len(main) == 1 and main[0]["uuid_edge"] == "e1" and [main[0]["position_from"], main[0]["position_to"]] == [0, 20]
        tongue = next(e for e in n["edges"] if e["node_side"] == 0)
        assert tongue["main_edge"] is None and tongue["position_from"] is None


def test_double_crossing_and_plain_nodes(spark):
    n = switch(spark, (-1, 0, 50.0), (-1, -0.2, 25.0), (1, 0, 50.0), (1, 0.2, 25.0))
    assert n["switch_type"]["tpe"] == "DCS" and n["switch_type"]["sub_tpe"] is None and n["arity"] == 4
    assert sum(bool(e["main_edge"]) for e in n["edges"]) == 2 and all(e["position_to"] - e["position_from"] == pytest.approx(10) for e in n["edges"])
    assert switch(spark, (-1, 0, None), (1, 0, None))["switch_type"] is None
    assert switch(spark, (1, 0, None), (1, 0.1, None), (1, 0.2, None))["edges"] is None


def candidates_of(spark, rows):
    return spark.createDataFrame([(e, i, float(i), p, 3, float(x), float(y), float(z), float(a)) for e, i, p, x, y, z, a in rows], CANDIDATE)


def test_snap_single_point(spark):
    known = lambda x, y, z=0.0, a=0.0: spark.createDataFrame([(77 << 12, 1, 77, x, y, z, a)], S.PP)
    new = candidates_of(spark, [("e", 1, 1, 0, 0, 0, 0)])
    assert not S.snap(new, known(0.12, 0.1)).first()["is_new_pp"]
    assert S.snap(new, known(0.27, 0.1)).first()["is_new_pp"]
    assert S.snap(new, known(0.12, 0.1, 10.0)).first()["is_new_pp"]
    nan = candidates_of(spark, [("e", 1, 1, 0, 0, float("nan"), 0)])
    assert not S.snap(nan, known(0.12, 0.1)).first()["is_new_pp"]
    for azimuth, want in ((0.3, 1), (math.pi, -1), (math.pi / 2, None)):
        assert S.mapping(S.snap(new, known(0.1, 0.1, a=azimuth))).first()["direction"] == want


def test_snap_square_and_repeat(spark):
    side = [0.125 + 0.25 * i for i in range(5)]
    rows = [(f"e{k}", i, k + 1, *p, 0, 0) for k, f in enumerate((lambda s: (s, 0), lambda s: (1.25, s), lambda s: (s, 1.25), lambda s: (0, s))) for i, p in enumerate(map(f, side))]
    c = candidates_of(spark, rows)
    first = E.cut(S.snap(c), "test")
    new = first.where("is_new_pp").count()
    assert first.count() == 20 and new == S.points(first).select("id_positionpoint").distinct().count() < 20
    again = S.snap(c, first.where("is_new_pp").select("snapped.*"))
    assert again.where("is_new_pp").count() == 0 and again.count() == 20


def test_snap_sees_across_cells(spark):
    size = 4.0
    rows = [(f"e{i}", 1, 1, size + d, 0.5, 0, 0) for i, d in enumerate((-0.05, 0.05))]
    assert S.snap(candidates_of(spark, rows)).where("is_new_pp").count() == 1


def brute_snap(rows, known, radius, height, size):
    """Every candidate against all points of earlier rounds and of earlier edges of its cell, one after the other."""
    cell = lambda x, y: (math.floor(x / size), math.floor(y / size))
    colour = lambda c: c[0] % 2 * 2 + c[1] % 2
    points, out = list(known), {}
    for key in sorted({(r[2], colour(cell(r[3], r[4]))) for r in rows}):
        created = []
        for c in {cell(r[3], r[4]) for r in rows if (r[2], colour(cell(r[3], r[4]))) == key}:
            here = sorted(r for r in rows if r[2] == key[0] and cell(r[3], r[4]) == c)
            own = []
            for edge in sorted({r[0] for r in here}):
                fresh = []
                for name, i, _, x, y, z, _ in (r for r in here if r[0] == edge):
                    near = [(math.hypot(p[0] - x, p[1] - y), p) for p in points + own]
                    near = [(d, p) for d, p in near if d < radius and (math.isnan(z) or math.isnan(p[2]) or abs(p[2] - z) <= height)]
                    out[name, i] = min(near)[1] if near else (x, y, z)
                    if not near:
                        fresh.append((x, y, z))
                own += fresh
            created += own
        points += created
    return out, len(points) - len(known)


def test_snap_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for e in range(40):
        x, y, a, z = *rng.uniform(0, 12, 2), rng.uniform(0, 6.28), rng.choice([0.0, 0.5, 5.0])
        rows += [(f"e{e:02}", i, int(1 + e % 3), float(x + 0.25 * i * math.cos(a)), float(y + 0.25 * i * math.sin(a)), float(z), 0.0) for i in range(20)]
    known = [(float(x), float(y), 0.25) for x, y in rng.uniform(0, 12, (60, 2))]
    existing = spark.createDataFrame([((k + 1) << 12, 3, k + 1, *p, 0.0) for k, p in enumerate(known)], S.PP)
    got = S.snap(candidates_of(spark, rows), existing).collect()
    want, created = brute_snap(rows, known, S.RADIUS, S.HEIGHT_TOLERANCE, 4.0)
    assert len(got) == len(rows) and 100 < sum(r["is_new_pp"] for r in got) == created < len(rows) - 50
    for r in got:
        assert (r["snapped"]["x"], r["snapped"]["y"], r["snapped"]["z"]) == pytest.approx(want[r["uuid_edge"], r["edge_idx"]])
    assert len({r["snapped"]["id_positionpoint"] for r in got if r["is_new_pp"]}) == created


def test_snap_blocks_against_brute_force(spark, monkeypatch):
    """Small blocks, so that edges and chains of snapped points cross their borders; three priorities make two passes."""
    monkeypatch.setattr(S, "SIDES", (8,))
    rng = np.random.default_rng(5)
    rows = []
    for e in range(60):
        x, y, a, z = *rng.uniform((-70, -4), (70, 4)), rng.uniform(0, 6.28), rng.choice([0.0, 0.5, float("nan")])
        rows += [(f"e{e:02}", i, int(1 + e % 3), float(x + 0.25 * i * math.cos(a)), float(y + 0.25 * i * math.sin(a)), float(z), 0.0) for i in range(20)]
        x0 = -70 + 140 * e / 60  # beside each other along the x axis, across all blocks
        rows += [(f"f{e:02}", i, int(1 + e % 2), float(x0 + 0.2 * i), 0.1 * (e % 3), 0.0, 0.0) for i in range(20)]
    known = [(float(x), float(y), 0.25) for x, y in rng.uniform((-70, -2), (70, 2), (60, 2))]
    existing = spark.createDataFrame([((k + 1) << 12, 3, k + 1, *p, 0.0) for k, p in enumerate(known)], S.PP)
    got = S.snap(candidates_of(spark, rows), existing).collect()
    want, created = brute_snap(rows, known, S.RADIUS, S.HEIGHT_TOLERANCE, 4.0)
    assert len(got) == len(rows) and 100 < sum(r["is_new_pp"] for r in got) == created < len(rows) - 50
    for r in got:
        assert (r["snapped"]["x"], r["snapped"]["y"]) == pytest.approx(want[r["uuid_edge"], r["edge_idx"]][:2])
    assert len({r["snapped"]["id_positionpoint"] for r in got if r["is_new_pp"]}) == created


def test_snap_many_cells_in_time(spark):
    """60,000 cells: no work per cell in Python."""
    c = spark.range(60_000).selectExpr("concat('e', id) AS uuid_edge", "1 AS edge_idx", "0D AS position", "2 AS prio", "3 AS zoom", "4D * (id % 300) + 1 AS x", "4D * (id div 300) + 1 AS y", "0D AS z", "0D AS azimuth")
    began = time.time()
    assert S.snap(c).where("is_new_pp").agg(F.count_distinct("snapped.id_positionpoint")).first()[0] == 60_000
    assert time.time() - began < 30


def test_snap_does_not_depend_on_partitions(spark):
    t = fixtures.tracks(spark, SF).where("k < 12").withColumnRenamed("uuid_track", "uuid_edge")
    c = P.edge_points(t, ["uuid_edge"]).withColumn("prio", F.lit(2))
    key = lambda df: sorted((r["uuid_edge"], r["edge_idx"], r["snapped"]["id_positionpoint"]) for r in df.collect())
    assert key(S.snap(c)) == key(S.snap(c.repartition(7, "edge_idx")))


def test_lines():
    a = [np.array(x, dtype=float) for x in ([(0, 0), (500, 0)], [(1000, 0), (500, 0)], [(0, 10), (1000, 10)], [(500, 0), (500, 400)])]
    merged = L.merge_smooth(a)
    assert sorted(round(L.length(m)) for m in merged) == [400, 1000, 1000]
    assert [L.simplify(c).tolist() for c in L.centre_lines(merged)][0] == [[0, 5], [1000, 5]]
    ring = [np.array(x, dtype=float) for x in ([(0, 0), (10, 1)], [(10, 1), (20, 0)], [(20, 0), (0, 0)])]
    assert L.merge_smooth(ring) == []


def test_published(spark):
    df = spark.createDataFrame([(1, 0, ["a"], {"k": 1}), (2, 3, [], {})], "id int, zoom int, tags array<string>, props map<string,int>")
    assert [r["tags"] for r in G.jsonify(df).orderBy("id").collect()] == ['["a"]', "[]"]
    assert sorted((r["id"], r["z_level"]) for r in G.zoom_fanout(df, {15: "zoom <= 1", 21: "zoom <= 3"}).collect()) == [(1, 15), (1, 21), (2, 21)]
    assert G.deduplicate(df.unionByName(df), ["id"], "zoom").count() == 2


def test_snap_queries_take_all_tracks(spark, tmp_path):
    from trackweave.queries import points as Q

    spark.range(203, 211).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    rounds = Q.snap_rounds(spark, str(tmp_path)).collect()
    assert sum(r["candidates"] for r in rounds) == Q._candidates(spark, str(tmp_path)).count()
    new = [r for r in rounds if r["is_new_pp"]]
    assert all(r["candidates"] == r["points"] for r in new)
    assert Q.snap_points(spark, str(tmp_path)).count() == sum(r["points"] for r in new)


def test_snap_rounds_in_time(spark):
    from trackweave.queries import points as Q

    began = time.time()
    rounds = Q.snap_rounds(spark, SF).collect()
    assert time.time() - began < 30
    assert {(r["prio"], r["is_new_pp"]) for r in rounds} == {(p, new) for p in (1, 2) for new in (False, True)}
    assert sum(r["candidates"] for r in rounds) == Q._candidates(spark, SF).count()
    assert all(r["candidates"] == r["points"] for r in rounds if r["is_new_pp"])


def test_direction_at_135_degrees(spark, tmp_path):
    """Keys whose angles differ by 45 or 135 degrees but for rounding: as in SQL."""
    import duckdb

    from trackweave.queries import points as Q

    spark.range(14040).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")  # all pairs of angles
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert {tuple(r) for r in Q.direction(spark, str(tmp_path)).collect()} == set(con.sql(Q.ORACLES["direction"]).fetchall())


def test_gold_ids_do_not_collide(spark, tmp_path):
    """Keys of whose points, in 1 GB, some agreed in the 48 bits of MD5 that were the ids."""
    import duckdb

    from trackweave.queries import points as Q

    keys = [785960, 760662, 586847, 703775, 686875, 467882, 243364, 287702, 899999]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    df = Q.gold_pp(spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({Q.ORACLES['gold_pp']})").fetchall()
    key = lambda rows: sorted((tuple(r) for r in rows), key=lambda r: r[:2])
    assert len(want) > 300 and key(df.collect()) == key(want)


def test_snap_rounds_packs_candidates(spark, tmp_path, monkeypatch):
    """1.6 million candidates: they are written and shuffled by tile, not one by one; the counts are those of snap."""
    from trackweave.queries import points as Q

    spark.range(15_000).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    written = []
    monkeypatch.setattr(S, "cut", lambda df, name: written.append(E.cut(df, name)) or written[-1])
    began = time.time()
    rounds = Q.snap_rounds(spark, str(tmp_path)).collect()
    assert time.time() - began < 60
    candidates = sum(r["candidates"] for r in rounds)
    assert 1_000_000 < candidates == Q._candidates(spark, str(tmp_path)).count() and 0 < sum(w.count() for w in written) < candidates / 20
    whole = S.snap(Q._candidates(spark, str(tmp_path))).groupBy("prio", "is_new_pp")
    assert set(rounds) == set(whole.agg(F.count("*").alias("candidates"), F.count_distinct("snapped.id_positionpoint").alias("points")).collect())


def test_snap_rounds_counts_all_passes(spark, monkeypatch):
    """Five priorities in three passes, small blocks and tasks, known points; missing heights, names and positions stay missing."""
    monkeypatch.setattr(S, "SIDES", (8,))
    monkeypatch.setattr(S, "TASK_ROWS", 1000)
    c = P.edge_points(fixtures.tracks(spark, SF).withColumnRenamed("uuid_track", "uuid_edge"), ["uuid_edge", "k"])
    known = c.where("edge_idx % 7 = 0").selectExpr("xxhash64(uuid_edge, edge_idx) AS id_positionpoint", "cast(zoom AS int) AS zoom", "k AS cell", "x + 0.1D AS x", "y + 0.05D AS y", "cast(z AS double) AS z", "cast(azimuth AS double) AS azimuth")
    c = c.selectExpr("CASE WHEN k <> 77 THEN uuid_edge END AS uuid_edge", "edge_idx", "CASE WHEN k % 13 <> 5 THEN position END AS position", "cast(1 + k % 5 AS smallint) AS prio", "zoom", "x", "y", "CASE WHEN k % 11 <> 3 THEN z END AS z", "azimuth")
    c, known = E.cut(c, "test"), E.cut(known, "test")
    s = E.cut(S.snap(c, known), "test")
    own = ["uuid_edge", "edge_idx", "position", "x", "y", "cast(z AS double) AS z"]
    assert s.selectExpr(*own).exceptAll(c.selectExpr(*own)).count() == 0 and s.count() == c.count()
    assert s.where("is_new_pp AND NOT (snapped.z <=> z)").count() == 0 and s.where("z IS NULL").count() > 0
    whole = s.groupBy("prio", "is_new_pp").agg(F.count("*").alias("candidates"), F.count_distinct("snapped.id_positionpoint").alias("points"))
    assert set(S.rounds(c, known).collect()) == set(whole.collect()) and whole.count() == 10
