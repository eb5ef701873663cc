"""Edges to nodes: endpoints, switches and the zones in which an edge belongs to a switch.

All steps are window functions over one shuffle by node. A node's edges are ordered by uuid_edge. Edges
that leave within 90 degrees of the first one form its cluster, the others the second one; c1 is the
smaller cluster. Angles are normalised before they are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as g

#: Longest zones of single, double and double crossing switches, in metres.
ZONE = {"SS": 20, "DS": 20, "DCS": 10}


def node_points(edges: DataFrame) -> DataFrame:
    """Both ends of each edge: uuid_node, x, y, z, x1, y1, z1 (next vertex), azimuth, radius, chord_length, end,
    uuid_edge, edge_length and tags."""
    lined = edges.select("uuid_edge", "uuid_node_from", "uuid_node_to", "tags", "line", g.line_length("line").alias("edge_length"))
    side = lambda node, a, b, c, end: F.expr(f"named_struct('uuid_node', {node}, 'p', {a}, 'q', {b}, 'r', {c}, 'end', {end})")
    both = F.array(
        side("uuid_node_from", "get(line, 0)", "get(line, 1)", "get(line, 2)", "false"),
        side("uuid_node_to", "get(line, size(line) - 1)", "get(line, size(line) - 2)", "get(line, size(line) - 3)", "true"),
    )
    out = lined.select("uuid_edge", "edge_length", "tags", F.explode(both).alias("e")).select("uuid_edge", "edge_length", "tags", "e.*")
    radius = F.expr(f"CASE WHEN r IS NOT NULL THEN cast({g.circumradius('p', 'q', 'r')} AS int) END")
    return out.select(
        "uuid_node", "p.x", "p.y", "p.z", F.col("q.x").alias("x1"), F.col("q.y").alias("y1"), F.col("q.z").alias("z1"),
        F.expr(g.azimuth("p", "q")).alias("azimuth"), radius.alias("radius"), F.expr(f"CASE WHEN r IS NOT NULL THEN {g.distance('p', 'r')} END").alias("chord_length"),
        "end", "uuid_edge", "edge_length", "tags",
    ).where("azimuth IS NOT NULL")


def _clustered(points: DataFrame) -> DataFrame:
    w, order = Window.partitionBy("uuid_node"), Window.partitionBy("uuid_node").orderBy("uuid_edge", "end")
    out = points.withColumns({"arity": F.count("*").over(w), "_n": F.row_number().over(order), "_first": F.first("azimuth").over(order)})
    out = out.where("arity IN (3, 4)").withColumn("_a", F.expr(f"{g.angle_diff('azimuth', '_first')} < pi() / 2"))
    size = F.count(F.when(F.col("_a"), 1)).over(w)
    out = out.withColumn("_s", size)
    # c1 is the smaller cluster; the first one of two equal ones
    return out.withColumn("_c1", F.expr("CASE WHEN _s * 2 <= arity THEN _a ELSE NOT _a END")).withColumn("_k", F.least(F.col("_s"), F.col("arity") - F.col("_s")))


def switch_edges(points: DataFrame) -> DataFrame:
    """One row per edge end at a classified switch: uuid_node, tpe, sub_tpe, radius, uuid_edge, node_side,
    position_from, position_to and main_edge."""
    w = Window.partitionBy("uuid_node")
    c = _clustered(points).where("(arity = 3 AND _k = 1) OR (arity = 4 AND _k IN (1, 2))")
    c = c.withColumn("tpe", F.expr("CASE WHEN arity = 3 THEN 'SS' WHEN _k = 1 THEN 'DS' ELSE 'DCS' END"))
    # c1's edge (the longest of two) gives the direction of the switch
    lead = F.struct("edge_length", (-F.col("_n")).alias("_o"), "azimuth", "x1", "y1", "uuid_edge", "end")
    c = c.withColumn("_lead", F.max(F.when(F.col("_c1"), lead)).over(w))
    through = f"({g.normalize('_lead.azimuth - pi()')})"
    c = c.withColumn("_off", F.expr(f"CASE WHEN NOT _c1 THEN {g.angle_diff(through, 'azimuth')} END"))
    c = c.withColumn("_main", F.min(F.when(~F.col("_c1"), F.struct("_off", "_n"))).over(w)["_n"])
    branch = F.struct("_n", F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")).alias("q"), "radius")
    c = c.withColumn("_branch", F.min(F.when(~F.col("_c1") & (F.col("_n") != F.col("_main")), branch)).over(w))
    c = c.withColumns({"_p0": F.struct(F.col("_lead.x1").alias("x"), F.col("_lead.y1").alias("y")), "_p1": F.struct("x", "y"), "_p2": F.col("_branch.q")})
    own = f"abs(cast({g.circumradius('_p0', '_p1', '_p2')} AS int))"
    c = c.withColumn("switch_radius", F.expr(f"CASE WHEN tpe = 'DCS' THEN {own} ELSE least(abs(_branch.radius), {own}) END"))
    turn = f"({g.normalize(f'azimuth - {through}')})"
    letters = F.array_sort(F.collect_list(F.expr(f"CASE WHEN NOT _c1 AND abs({turn}) >= pi() / 180 THEN {turn} END")).over(w))
    c = c.withColumn("_turns", letters)
    c = c.withColumn("sub_tpe", F.expr("CASE WHEN tpe <> 'DCS' THEN nullif(array_join(transform(_turns, t -> CASE WHEN t < 0 THEN 'R' ELSE 'L' END), ''), '') END"))
    limit = F.expr("CASE " + " ".join(f"WHEN tpe = '{k}' THEN {v}D" for k, v in ZONE.items()) + " END")
    c = c.withColumn("_zone", F.least(limit, F.min(F.when(~F.col("_c1"), F.col("edge_length"))).over(w)).cast("float").cast("double"))
    zoned = "(NOT _c1 OR tpe = 'DCS')"
    return c.select(
        "uuid_node", "arity", "tpe", "sub_tpe", F.col("switch_radius").alias("radius"), "uuid_edge", F.expr("cast(CASE WHEN _c1 THEN 0 ELSE 1 END AS smallint)").alias("node_side"),
        F.expr(f"CASE WHEN {zoned} THEN CASE WHEN end THEN edge_length - _zone ELSE 0D END END").alias("position_from"),
        F.expr(f"CASE WHEN {zoned} THEN CASE WHEN end THEN edge_length ELSE _zone END END").alias("position_to"),
        F.expr("CASE WHEN NOT _c1 THEN _n = _main WHEN tpe = 'DCS' THEN _n = -_lead._o END").alias("main_edge"),
    )


def nodes(edges: DataFrame) -> DataFrame:
    """uuid_node, x, y, z, arity, switch_type, edges (null unless the node is a switch) and tags."""
    points = node_points(edges)
    base = points.groupBy("uuid_node").agg(
        F.min("x").alias("x"), F.min("y").alias("y"), F.min("z").alias("z"), F.count("*").cast("short").alias("arity"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags")))).alias("tags"),
    )
    mapping = F.struct("uuid_edge", "node_side", "position_from", "position_to", "main_edge")
    switches = switch_edges(points).groupBy("uuid_node").agg(
        F.first(F.struct("tpe", "sub_tpe", "radius")).alias("switch_type"), F.array_sort(F.collect_list(mapping)).alias("edges")
    )
    return base.join(switches, "uuid_node", "left").select("uuid_node", "x", "y", "z", "arity", "switch_type", "edges", "tags")


def zones(node_table: DataFrame) -> DataFrame:
    """Switch zones of a node table: uuid_node, uuid_edge, position_from, position_to, main_edge."""
    return node_table.select("uuid_node", F.explode("edges").alias("e")).select("uuid_node", "e.uuid_edge", "e.position_from", "e.position_to", "e.main_edge")
