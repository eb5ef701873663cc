"""Points, edges, nodes and candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixtures
from ..functions import geometry as g
from ..operators import edges as E
from ..operators import nodes as N
from ..operators import points as P
from ..plans.store import cut

_POINT_COLUMNS = [
    "edge_idx", "round(position, 5) AS position", "round(x, 6) AS x", "round(y, 6) AS y", "round(cast(z AS double), 4) AS z", "cast(zoom AS int) AS zoom",
    "radius", "round(cast(grade AS double), 6) AS grade", "round(cast(azimuth AS double), 5) AS azimuth", "well_defined",
]


def edge_points(spark, sf_dir: str) -> DataFrame:
    """One edge per track: all its position points."""
    return P.edge_points(fixtures.tracks(spark, sf_dir), ["uuid_track"]).selectExpr("uuid_track", *_POINT_COLUMNS)


def edge_point_zoom(spark, sf_dir: str) -> DataFrame:
    points = P.edge_points(fixtures.tracks(spark, sf_dir), ["type"], interval=0.5)
    return points.groupBy("type", F.col("zoom").cast("int").alias("zoom")).agg(F.count("*").alias("n"), F.round(F.sum("position"), 2).alias("positions"))


def line_positions(spark, sf_dir: str) -> DataFrame:
    t = fixtures.tracks(spark, sf_dir).select("uuid_track", F.posexplode(g.line_positions("line")).alias("i", "m"))
    return t.select("uuid_track", "i", F.round("m", 6).alias("m"))


def line_points_radius(spark, sf_dir: str) -> DataFrame:
    t = P.line_points(fixtures.tracks(spark, sf_dir), ["uuid_track"]).select("uuid_track", F.posexplode_outer("_points").alias("i", "p"))  # no inferred filter
    return t.select("uuid_track", "i", F.round("p.m", 6).alias("m"), "p.radius", "p.well_defined")


def vertex_measures(spark, sf_dir: str) -> DataFrame:
    """Circumradius, azimuths, angle, grade and extension at the middle vertex of each track."""
    t = fixtures.tracks(spark, sf_dir).selectExpr("uuid_track", "get(line, 0) AS a", "get(line, 1) AS b", "get(line, 2) AS c")
    diff = g.angle_diff(g.azimuth("a", "b"), g.azimuth("b", "c"))
    return t.selectExpr(
        "uuid_track", f"round({g.circumradius('a', 'b', 'c')}, 4) AS radius", f"round({g.azimuth('a', 'b')}, 6) AS azimuth", f"round({diff}, 6) AS turn",
        f"round({g.grade('a', 'b')}, 8) AS grade", f"{g.is_extension('a', 'b', 'b', 'c')} AS extension", f"round({g.distance('a', 'c')}, 6) AS chord",
    )


def split_acute(spark, sf_dir: str) -> DataFrame:
    """Doubled-back lines (a, middle, a moved) cut at their acute vertex."""
    t = fixtures.tracks(spark, sf_dir).selectExpr("uuid_track", "k", "CASE WHEN k % 4 = 0 THEN array(get(line, 0), get(line, 1), named_struct('x', get(line, 0).x + 1, 'y', get(line, 0).y, 'z', 0D)) ELSE line END AS line")
    parts = t.select("uuid_track", F.posexplode(g.split_acute("line")).alias("part", "l"))
    return parts.select("uuid_track", "part", F.size("l").alias("n_points"), F.round(g.line_length("l"), 6).alias("length"))


def merge_lines(spark, sf_dir: str) -> DataFrame:
    """Chain tracks k and k + 1 joined at their common vertex, as flat text."""
    c = fixtures.tracks(spark, sf_dir).where("type = 'c'")
    n = c.select(F.col("a").alias("_a"), F.col("line").alias("_next"))
    both = c.join(n, c["b"] == n["_a"]).select("k", g.merge_lines("line", "_next").alias("l"))
    flat = F.expr("array_join(transform(l, p -> concat(cast(cast(p.x AS bigint) AS string), ':', cast(cast(floor(p.y * 2) AS bigint) AS string))), ' ')")
    return both.select("k", flat.alias("points"))


def endpoint_degree(spark, sf_dir: str) -> DataFrame:
    return E.endpoint_degree(fixtures.tracks(spark, sf_dir))


def _edges(spark, sf_dir: str) -> DataFrame:
    return cut(E.merge_edges(fixtures.tracks(spark, sf_dir)), "edges")


def merge_edges(spark, sf_dir: str) -> DataFrame:
    return E.merge_edges(fixtures.tracks(spark, sf_dir)).select(
        "uuid_edge", F.size("tracks").cast("long").alias("n_tracks"), F.size("line").cast("long").alias("n_points"), F.round(g.line_length("line"), 6).alias("length"),
        "uuid_node_from", "uuid_node_to", F.array_join("tags", ",").alias("tags"),
    )


def edge_track_refs(spark, sf_dir: str) -> DataFrame:
    e = E.merge_edges(fixtures.tracks(spark, sf_dir)).select("uuid_edge", F.explode("tracks").alias("t"))
    return e.select("uuid_edge", "t.uuid_track", F.round("t.position_from", 6).alias("position_from"), F.round("t.position_to", 6).alias("position_to"), F.col("t.direction").cast("int").alias("direction"))


def node_points(spark, sf_dir: str) -> DataFrame:
    return N.node_points(_edges(spark, sf_dir)).selectExpr(
        "uuid_node", "uuid_edge", "`end` AS at_end", "round(azimuth, 6) AS azimuth", "radius", "round(chord_length, 6) AS chord_length", "round(edge_length, 6) AS edge_length"
    )


def node_arity_tags(spark, sf_dir: str) -> DataFrame:
    return N.nodes(_edges(spark, sf_dir)).selectExpr("uuid_node", "cast(arity AS int) AS arity", "array_join(tags, ',') AS tags", "round(x, 3) AS x", "round(y, 3) AS y")


def switch_classify(spark, sf_dir: str) -> DataFrame:
    return N.nodes(_edges(spark, sf_dir)).where("switch_type IS NOT NULL").selectExpr("uuid_node", "switch_type.tpe AS tpe", "switch_type.sub_tpe AS sub_tpe", "switch_type.radius AS radius")


def switch_mapping(spark, sf_dir: str) -> DataFrame:
    return N.switch_edges(N.node_points(_edges(spark, sf_dir))).selectExpr(
        "uuid_node", "uuid_edge", "cast(node_side AS int) AS node_side", "round(position_from, 5) AS position_from", "round(position_to, 5) AS position_to", "main_edge"
    )


def pp_candidates(spark, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir)
    c = P.candidates(e, N.zones(N.nodes(e)))
    return c.groupBy("uuid_edge", F.col("prio").cast("int").alias("prio"), F.col("zoom").cast("int").alias("zoom")).agg(
        F.count("*").alias("n"), F.sum(F.round(F.col("position") * 100000).cast("long")).alias("positions"), F.round(F.sum("x"), 2).alias("xs"), F.count("radius").alias("radii")
    )


# SQL for DuckDB. Geometry is spelled out anew there: flat vertices, unnested segments and window functions.
_TRACKS = f"WITH RECURSIVE {fixtures.SQL}"
_NORM = lambda a: f"(({a}) - 2 * pi() * ceil((({a}) - pi()) / (2 * pi())))"
_RADIUS = lambda p, q, r: (
    f"(SELECT CASE WHEN abs(v) <= 100000 THEN v END FROM (SELECT sqrt(({q}.x-{p}.x)**2 + ({q}.y-{p}.y)**2) * sqrt(({r}.x-{q}.x)**2 + ({r}.y-{q}.y)**2) * sqrt(({p}.x-{r}.x)**2 + ({p}.y-{r}.y)**2)"
    f" / nullif(4 * ((({q}.x-{p}.x)*({r}.y-{p}.y) - ({r}.x-{p}.x)*({q}.y-{p}.y)) / 2), 0) AS v))"
)
_LINES = """,
lines AS (SELECT *, [{'x': ax, 'y': ay, 'z': az}, {'x': mx, 'y': my, 'z': mz}, {'x': bx, 'y': "by", 'z': bz}] AS line FROM tracks)"""


def _points_sql(source: str, key: str, interval: float) -> str:
    """Points of the lines of `source` (key, line): vertices, segments, points, and neighbours by window."""
    return f""",
    v AS (SELECT {key}, i, line[i + 1].x AS x, line[i + 1].y AS y, line[i + 1].z AS z, len(line) AS nv FROM (SELECT *, unnest(range(0, len(line))) AS i FROM {source})),
    d AS (SELECT *, sqrt((x - lag(x) OVER w)**2 + (y - lag(y) OVER w)**2) AS back, sqrt((x - lead(x) OVER w)**2 + (y - lead(y) OVER w)**2) AS ahead,
        {{'x': lag(x) OVER w, 'y': lag(y) OVER w}} AS p, {{'x': x, 'y': y}} AS q, {{'x': lead(x) OVER w, 'y': lead(y) OVER w}} AS r FROM v WINDOW w AS (PARTITION BY {key} ORDER BY i)),
    lp AS (SELECT *, coalesce(sum(back) OVER (PARTITION BY {key} ORDER BY i), 0) AS m, coalesce(back <= 25, true) AND coalesce(ahead <= 25, true) AS wd,
        CASE WHEN coalesce(back <= 25, true) AND coalesce(ahead <= 25, true) THEN floor({_RADIUS("p", "q", "r")} + 0.5)::int END AS radius FROM d),
    seg AS (SELECT *, lead(m) OVER w AS m2, lead(x) OVER w AS x2, lead(y) OVER w AS y2, lead(z) OVER w AS z2, lead(radius) OVER w AS radius2, lead(wd) OVER w AS wd2, max(m) OVER (PARTITION BY {key}) AS length
        FROM lp WINDOW w AS (PARTITION BY {key} ORDER BY i)),
    num AS (SELECT {key}, length, floor(length / {interval})::int AS n FROM (SELECT DISTINCT {key}, length FROM seg)),
    pos AS (SELECT {key}, k, floor(((length - n * {interval}) / 2 + (k - 0.5) * {interval}) * 100000 + 0.5) / 100000 AS pos, n FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM num)),
    pt AS (SELECT pos.{key}, k::int AS edge_idx, pos AS position, n, x + (x2 - x) * f AS x, y + (y2 - y) * f AS y, z + (z2 - z) * f AS z,
        trunc(coalesce(radius + (radius2 - radius) * f, radius, radius2))::int AS radius, wd OR wd2 AS well_defined
      FROM (SELECT pos.*, seg.* EXCLUDE ({key}), (pos - m) / (m2 - m) AS f FROM pos JOIN seg ON pos.{key} = seg.{key} AND m2 IS NOT NULL AND (pos > m OR i = 0) AND pos <= m2) AS pos),
    nb AS (SELECT *, max(position) OVER (PARTITION BY {key}) AS lastpos, coalesce(lag(x) OVER w, x) AS px, coalesce(lag(y) OVER w, y) AS py, coalesce(lag(z) OVER w, z) AS pz,
        coalesce(lead(x) OVER w, x) AS nx, coalesce(lead(y) OVER w, y) AS ny, coalesce(lead(z) OVER w, z) AS nz FROM pt WINDOW w AS (PARTITION BY {key} ORDER BY edge_idx)),
    points AS (SELECT {key}, edge_idx, position, x, y, z::float AS z,
        CASE WHEN position = 0 OR position = lastpos THEN 0 WHEN floor(position / {interval})::int % {int(10 / interval)} = 0 THEN 1 WHEN floor(position / {interval})::int % {int(1 / interval)} = 0 THEN 2 ELSE 3 END AS zoom,
        radius, ((nz - pz) / nullif(sqrt((nx - px)**2 + (ny - py)**2), 0) / 1000)::float AS grade, atan2(ny - py, nx - px)::float AS azimuth, well_defined FROM nb)"""


_EDGES = """,
dt AS (SELECT uuid_track, list_sort(list_distinct(tags)) AS tags, line, 1 AS dir, (floor(ax * 1000 + 0.5))::bigint || ',' || (floor(ay * 1000 + 0.5))::bigint AS p, (floor(bx * 1000 + 0.5))::bigint || ',' || (floor("by" * 1000 + 0.5))::bigint AS q FROM lines
  UNION ALL SELECT uuid_track, list_sort(list_distinct(tags)), list_reverse(line), -1, (floor(bx * 1000 + 0.5))::bigint || ',' || (floor("by" * 1000 + 0.5))::bigint, (floor(ax * 1000 + 0.5))::bigint || ',' || (floor(ay * 1000 + 0.5))::bigint FROM lines),
deg AS (SELECT p, count(*) AS degree, count(*) = 2 AND count(DISTINCT uuid_track) = 2 AND count(DISTINCT tags) = 1 AS passed FROM dt GROUP BY p),
walk AS (
  SELECT uuid_track AS head, dir AS head_dir, 0 AS rank, uuid_track, dir, q FROM dt JOIN deg USING (p) WHERE NOT passed
  UNION ALL SELECT head, head_dir, rank + 1, dt.uuid_track, dt.dir, dt.q FROM walk JOIN deg ON deg.p = walk.q AND passed JOIN dt ON dt.p = walk.q AND dt.uuid_track <> walk.uuid_track),
kept AS (SELECT * FROM walk WINDOW w AS (PARTITION BY head, head_dir ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) QUALIFY (head, -head_dir) <= (last_value(uuid_track) OVER w, last_value(dir) OVER w)),
withline AS (SELECT kept.*, dt.line, dt.tags, (SELECT sum(sqrt((line[i + 1].x - line[i].x)**2 + (line[i + 1].y - line[i].y)**2)) FROM (SELECT unnest(range(1, len(line))) AS i)) AS length FROM kept JOIN dt USING (uuid_track, dir)),
merged AS (SELECT head, head_dir, flatten(list(CASE WHEN rank = 0 THEN line ELSE line[2:] END ORDER BY rank)) AS line, string_agg(uuid_track, '|' ORDER BY rank) AS names, count(*) AS n_tracks, sum(length) AS length, any_value(tags) AS tags FROM withline GROUP BY head, head_dir),
edges AS (SELECT *, %s AS uuid_edge, %s AS uuid_node_from, %s AS uuid_node_to FROM (SELECT *, md5(names) AS h1,
  md5((floor(line[1].x * 1000 + 0.5))::bigint || ',' || (floor(line[1].y * 1000 + 0.5))::bigint) AS h2, md5((floor(line[-1].x * 1000 + 0.5))::bigint || ',' || (floor(line[-1].y * 1000 + 0.5))::bigint) AS h3 FROM merged))""" % tuple(
    f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-3' || substr({h}, 14, 3) || '-' || substr('89ab', ((instr('0123456789abcdef', substr({h}, 17, 1)) - 1) & 3) + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)" for h in ("h1", "h2", "h3")
)
_NODE_POINTS = f""",
ends2 AS (SELECT uuid_node_from AS uuid_node, uuid_edge, false AS at_end, line[1] AS p, line[2] AS q, CASE WHEN len(line) > 2 THEN line[3] END AS r, length, tags FROM edges
  UNION ALL SELECT uuid_node_to, uuid_edge, true, line[-1], line[-2], CASE WHEN len(line) > 2 THEN line[-3] END, length, tags FROM edges),
np AS (SELECT *, atan2(q.y - p.y, q.x - p.x) AS azimuth, CASE WHEN r IS NOT NULL THEN trunc({_RADIUS("p", "q", "r")})::int END AS radius, sqrt((r.x - p.x)**2 + (r.y - p.y)**2) AS chord_length FROM ends2)"""
_SWITCH = f""",
c0 AS (SELECT *, count(*) OVER (PARTITION BY uuid_node) AS arity, row_number() OVER w AS n, first_value(azimuth) OVER w AS a0 FROM np WINDOW w AS (PARTITION BY uuid_node ORDER BY uuid_edge, at_end)),
c1 AS (SELECT *, abs({_NORM("azimuth - a0")}) < pi() / 2 AS near FROM c0 WHERE arity IN (3, 4)),
c2 AS (SELECT *, count(*) FILTER (WHERE near) OVER (PARTITION BY uuid_node) AS s FROM c1),
c3 AS (SELECT *, CASE WHEN s * 2 <= arity THEN near ELSE NOT near END AS tongue, CASE WHEN arity = 3 THEN 'SS' WHEN least(s, arity - s) = 1 THEN 'DS' ELSE 'DCS' END AS tpe FROM c2 WHERE least(s, arity - s) BETWEEN 1 AND 2),
lead1 AS (SELECT uuid_node, n AS lead_n, azimuth AS lead_az, q AS lead_q FROM c3 WHERE tongue QUALIFY row_number() OVER (PARTITION BY uuid_node ORDER BY length DESC, n) = 1),
main2 AS (SELECT uuid_node, n AS main_n FROM c3 JOIN lead1 USING (uuid_node) WHERE NOT tongue QUALIFY row_number() OVER (PARTITION BY uuid_node ORDER BY abs({_NORM(_NORM("lead_az - pi()") + " - azimuth")}), n) = 1),
branch AS (SELECT uuid_node, q AS branch_q, radius AS branch_radius FROM c3 JOIN main2 USING (uuid_node) WHERE NOT tongue AND n <> main_n QUALIFY row_number() OVER (PARTITION BY uuid_node ORDER BY n) = 1),
turns AS (SELECT uuid_node, string_agg(CASE WHEN t < 0 THEN 'R' ELSE 'L' END, '' ORDER BY t) AS letters FROM (SELECT uuid_node, {_NORM("azimuth - " + _NORM("lead_az - pi()"))} AS t FROM c3 JOIN lead1 USING (uuid_node) WHERE NOT tongue) WHERE abs(t) >= pi() / 180 GROUP BY uuid_node),
zone AS (SELECT uuid_node, least(CASE any_value(tpe) WHEN 'DCS' THEN 10 ELSE 20 END, min(length) FILTER (WHERE NOT tongue))::float::double AS zone FROM c3 GROUP BY uuid_node),
sw AS (SELECT c3.*, lead_n, main_n, zone.zone, CASE WHEN tpe <> 'DCS' THEN letters END AS sub_tpe, abs(trunc({_RADIUS("lead_q", "p", "branch_q")})::int) AS own_radius, branch_radius
  FROM c3 JOIN lead1 USING (uuid_node) JOIN main2 USING (uuid_node) JOIN branch USING (uuid_node) JOIN zone USING (uuid_node) LEFT JOIN turns USING (uuid_node)),
mapped AS (SELECT uuid_node, uuid_edge, CASE WHEN tongue THEN 0 ELSE 1 END AS node_side,
  CASE WHEN NOT tongue OR tpe = 'DCS' THEN CASE WHEN at_end THEN length - zone ELSE 0 END END AS position_from,
  CASE WHEN NOT tongue OR tpe = 'DCS' THEN CASE WHEN at_end THEN length ELSE zone END END AS position_to,
  CASE WHEN NOT tongue THEN n = main_n WHEN tpe = 'DCS' THEN n = lead_n END AS main_edge FROM sw)"""

_ROUNDED = "edge_idx, round(position, 5) AS position, round(x, 6) AS x, round(y, 6) AS y, round(z::double, 4) AS z, zoom, radius, round(grade::double, 6) AS grade, round(azimuth::double, 5) AS azimuth, well_defined"
_ABC = "{'x': ax, 'y': ay, 'z': az} AS a1, {'x': mx, 'y': my, 'z': mz} AS b1, {'x': bx, 'y': \"by\", 'z': bz} AS c1"

QUERIES = {f.__name__: f for f in (edge_points, edge_point_zoom, line_positions, line_points_radius, vertex_measures, split_acute, merge_lines, endpoint_degree, merge_edges, edge_track_refs, node_points, node_arity_tags, switch_classify, switch_mapping, pp_candidates)}
ORACLES = {
    "edge_points": f"{_TRACKS}{_LINES}{_points_sql('lines', 'uuid_track', 0.25)} SELECT uuid_track, {_ROUNDED} FROM points",
    "edge_point_zoom": f"{_TRACKS}{_LINES}{_points_sql('lines', 'uuid_track', 0.5)} SELECT type, zoom, count(*) AS n, round(sum(position), 2) AS positions FROM points JOIN tracks USING (uuid_track) GROUP BY type, zoom",
    "line_positions": f"{_TRACKS} SELECT uuid_track, i, round(CASE i WHEN 0 THEN 0 WHEN 1 THEN l1 ELSE l1 + l2 END, 6) AS m FROM (SELECT uuid_track, sqrt((mx-ax)**2 + (my-ay)**2) AS l1, sqrt((bx-mx)**2 + (\"by\"-my)**2) AS l2, unnest([0, 1, 2]) AS i FROM tracks)",
    "line_points_radius": f"{_TRACKS}{_LINES}{_points_sql('lines', 'uuid_track', 0.25)} SELECT uuid_track, i::int AS i, round(m, 6) AS m, radius, wd AS well_defined FROM lp",
    "vertex_measures": f"""{_TRACKS} SELECT uuid_track, round({_RADIUS("a1", "b1", "c1")}, 4) AS radius, round(atan2(b1.y - a1.y, b1.x - a1.x), 6) AS azimuth, round(turn, 6) AS turn,
      round((b1.z - a1.z) / nullif(sqrt((b1.x-a1.x)**2 + (b1.y-a1.y)**2), 0) / 1000, 8) AS grade, turn < pi() / 4 AS extension, round(sqrt((c1.x-a1.x)**2 + (c1.y-a1.y)**2), 6) AS chord
      FROM (SELECT *, abs({_NORM("atan2(b1.y - a1.y, b1.x - a1.x) - atan2(c1.y - b1.y, c1.x - b1.x)")}) AS turn FROM (SELECT uuid_track, {_ABC} FROM tracks))""",
    "split_acute": f"""{_TRACKS}, f AS (SELECT uuid_track, ax, ay, mx, my, CASE WHEN k % 4 = 0 THEN ax + 1 ELSE bx END AS cx, CASE WHEN k % 4 = 0 THEN ay ELSE "by" END AS cy FROM tracks),
      h AS (SELECT *, sqrt((mx-ax)**2 + (my-ay)**2) AS l1, sqrt((cx-mx)**2 + (cy-my)**2) AS l2, abs({_NORM("atan2(ay - my, ax - mx) - atan2(cy - my, cx - mx)")}) <= pi() / 3 AS acute FROM f)
      SELECT uuid_track, 0 AS part, CASE WHEN acute THEN 2 ELSE 3 END AS n_points, round(CASE WHEN acute THEN l1 ELSE l1 + l2 END, 6) AS length FROM h UNION ALL SELECT uuid_track, 1, 2, round(l2, 6) FROM h WHERE acute""",
    "merge_lines": f"""{_TRACKS}, f AS (SELECT k, a, b, [ax, mx, bx] AS xs, [ay, my, "by"] AS ys FROM tracks WHERE type = 'c')
      SELECT s.k, array_to_string(list_transform(range(1, 6), lambda i: (s.xs || n.xs[2:])[i]::bigint || ':' || floor((s.ys || n.ys[2:])[i] * 2)::bigint), ' ') AS points FROM f AS s JOIN f AS n ON s.b = n.a""",
    "endpoint_degree": f"{_TRACKS}{_LINES}{_EDGES} SELECT p, degree, passed FROM deg",
    "merge_edges": f"{_TRACKS}{_LINES}{_EDGES} SELECT uuid_edge, n_tracks, len(line) AS n_points, round(length, 6) AS length, uuid_node_from, uuid_node_to, array_to_string(tags, ',') AS tags FROM edges",
    "edge_track_refs": f"""{_TRACKS}{_LINES}{_EDGES} SELECT uuid_edge, uuid_track, round(upto - l, 6) AS position_from, round(upto, 6) AS position_to, dir AS direction
      FROM (SELECT uuid_edge, w.uuid_track, w.dir, w.length AS l, sum(w.length) OVER (PARTITION BY w.head, w.head_dir ORDER BY rank) AS upto FROM withline AS w JOIN edges USING (head, head_dir))""",
    "node_points": f"{_TRACKS}{_LINES}{_EDGES}{_NODE_POINTS} SELECT uuid_node, uuid_edge, at_end, round(azimuth, 6) AS azimuth, radius, round(chord_length, 6) AS chord_length, round(length, 6) AS edge_length FROM np",
    "node_arity_tags": f"""{_TRACKS}{_LINES}{_EDGES}{_NODE_POINTS} SELECT uuid_node, count(*)::int AS arity, array_to_string(list_sort(list_distinct(flatten(list(tags)))), ',') AS tags, round(min(p.x), 3) AS x, round(min(p.y), 3) AS y FROM np GROUP BY uuid_node""",
    "switch_classify": f"""{_TRACKS}{_LINES}{_EDGES}{_NODE_POINTS}{_SWITCH} SELECT uuid_node, any_value(tpe) AS tpe, any_value(sub_tpe) AS sub_tpe, any_value(CASE WHEN tpe = 'DCS' THEN own_radius ELSE least(abs(branch_radius), own_radius) END) AS radius FROM sw GROUP BY uuid_node""",
    "switch_mapping": f"{_TRACKS}{_LINES}{_EDGES}{_NODE_POINTS}{_SWITCH} SELECT uuid_node, uuid_edge, node_side, round(position_from, 5) AS position_from, round(position_to, 5) AS position_to, main_edge FROM mapped",
    "pp_candidates": f"""{_TRACKS}{_LINES}{_EDGES}{_NODE_POINTS}{_SWITCH}{_points_sql("edges", "uuid_edge", 0.25)},
      mz AS (SELECT * FROM mapped WHERE main_edge),
      pr AS (SELECT points.*, CASE WHEN coalesce(position BETWEEN f.position_from AND f.position_to, false) OR coalesce(position BETWEEN t.position_from AND t.position_to, false) THEN 1 ELSE 2 END AS prio
        FROM points JOIN edges USING (uuid_edge) LEFT JOIN mz AS f ON f.uuid_edge = points.uuid_edge AND f.uuid_node = uuid_node_from LEFT JOIN mz AS t ON t.uuid_edge = points.uuid_edge AND t.uuid_node = uuid_node_to)
      SELECT uuid_edge, prio, zoom, count(*) AS n, sum(round(position * 100000)::bigint)::bigint AS positions, round(sum(x), 2) AS xs, count(radius) AS radii FROM pr GROUP BY uuid_edge, prio, zoom""",
}
