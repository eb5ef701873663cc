"""Tracks to edges: maximal chains of tracks through points where nothing branches.

Every track is looked at in both directions. A point is passed through if exactly two directed tracks
start there, of two tracks with the same tags, none of them excluded. Chains are found by pointer
doubling, in as many rounds as the logarithm of the longest chain, each one equi-join; the driver sees
counts only. A ring of passed-through points has no start: it is opened at its smallest and its largest
point (by coordinates), so that its edges have two different ends. Of both directions of a chain the
one stays that starts with the smaller track id (the track's own direction first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.ids import uuid3
from ..plans.store import cut


def point_key(point: str) -> Column:
    """A point as text, in millimetres."""
    return F.expr(f"concat(cast(floor({point}.x * 1000 + 0.5) AS bigint), ',', cast(floor({point}.y * 1000 + 0.5) AS bigint))")


def directed(tracks: DataFrame) -> DataFrame:
    """Both directions of each track: uuid_track, dir, tags, p (start) and q (end)."""
    ends = tracks.select("uuid_track", "tags", point_key("get(line, 0)").alias("_a"), point_key("element_at(line, -1)").alias("_b"))
    both = F.array(F.struct(F.lit(1).alias("dir"), F.col("_a").alias("p"), F.col("_b").alias("q")), F.struct(F.lit(-1).alias("dir"), F.col("_b").alias("p"), F.col("_a").alias("q")))
    return ends.select("uuid_track", F.array_sort(F.array_distinct("tags")).alias("tags"), F.explode(both).alias("_d")).select("uuid_track", "tags", "_d.*")


def endpoint_degree(tracks: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """p, degree (directed tracks that start there) and passed (is it passed through)."""
    d = directed(tracks)
    barred = F.max(F.col("uuid_track").isin(list(excluded))) if excluded else F.lit(False)
    per = d.groupBy("p").agg(
        F.count("*").alias("degree"), F.count_distinct("uuid_track").alias("_tracks"), F.min("tags").alias("_low"), F.max("tags").alias("_high"), barred.alias("_barred")
    )
    return per.select("p", "degree", ((F.col("degree") == 2) & (F.col("_tracks") == 2) & (F.col("_low") == F.col("_high")) & ~F.col("_barred")).alias("passed"))


def _links(d: DataFrame, passed: DataFrame) -> DataFrame:
    """Directed tracks with the one before them (null at the start of a chain)."""
    into = d.select(F.col("uuid_track").alias("_bu"), F.col("dir").alias("_bd"), F.col("q").alias("_bq"))
    open_ = passed.where("passed").select(F.col("p").alias("_pp"))
    before = into.join(open_, into["_bq"] == open_["_pp"]).drop("_pp")
    j = d.join(before, (d["p"] == before["_bq"]) & (d["uuid_track"] != before["_bu"]), "left")
    return j.select("uuid_track", "dir", "p", F.when(F.col("_bu").isNotNull(), F.struct(F.col("_bu").alias("u"), F.col("_bd").alias("d"))).alias("ptr"))


def _double(state: DataFrame) -> DataFrame:
    """One round: everyone's pointer jumps to the pointer of its target."""
    to = state.select(F.struct(F.col("uuid_track").alias("u"), F.col("dir").alias("d")).alias("_t"), F.col("ptr").alias("_ptr"), F.col("head").alias("_head"), F.col("rank").alias("_rank"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    j = state.join(to, state["ptr"] == to["_t"], "left")
    return j.select(
        "uuid_track", "dir", "p",
        F.col("_ptr").alias("ptr"),
        F.when(F.col("ptr").isNull(), F.col("head")).otherwise(F.col("_head")).alias("head"),
        (F.col("rank") + F.coalesce("_rank", F.lit(0))).alias("rank"),
        F.least("low", F.coalesce("_low", "low")).alias("low"),
        F.greatest("high", F.coalesce("_high", "high")).alias("high"),
    )


def _rank(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chains with head and rank, what is left on rings)."""
    own = F.struct(F.col("uuid_track").alias("u"), F.col("dir").alias("d"))
    state = links.select("uuid_track", "dir", "p", "ptr", F.when(F.col("ptr").isNull(), own).alias("head"), F.when(F.col("ptr").isNull(), 0).otherwise(1).alias("rank"), F.col("p").alias("low"), F.col("p").alias("high"))
    state = cut(state, "chains")
    seen = None
    while True:
        left, spread = state.where("ptr IS NOT NULL").agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if not left or (left, spread) == seen:  # nobody arrived and no minimum moved: rings only
            break
        seen = (left, spread)
        state = cut(_double(state), "chains")
    return state.where("ptr IS NULL"), state.where("ptr IS NOT NULL")


def chains(tracks: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """uuid_track, dir, head (u, d) and rank: every track once, in its place of its chain."""
    d = cut(directed(tracks), "directed")
    passed = cut(endpoint_degree(tracks, excluded), "degrees")
    done, rings = _rank(_links(d, passed))
    if not rings.isEmpty():
        opened = rings.select(F.explode(F.array("low", "high")).alias("_o")).distinct()
        passed = passed.join(opened, passed["p"] == opened["_o"], "left").withColumn("passed", F.col("passed") & F.col("_o").isNull()).drop("_o")
        done, _ = _rank(_links(d, passed))
    done = cut(done.select("uuid_track", "dir", "head", "rank"), "ranked")
    # a chain and its reverse: the start of one is the end of the other
    ends = done.groupBy("head").agg(F.max_by(F.struct(F.col("uuid_track").alias("u"), (-F.col("dir")).alias("d")), "rank").alias("back"))
    first = (F.col("head.u") < F.col("back.u")) | ((F.col("head.u") == F.col("back.u")) & (F.col("head.d") > F.col("back.d")))
    chosen = ends.where(first).select(F.col("head").alias("_h"))
    return done.join(chosen, done["head"] == chosen["_h"], "left_semi")


def merge_edges(tracks: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """uuid_edge, line, tracks (uuid_track, position_from, position_to, direction), uuid_node_from, uuid_node_to and tags."""
    ranked = chains(tracks, excluded)
    t = tracks.select(F.col("uuid_track").alias("_u"), "line", F.array_sort(F.array_distinct("tags")).alias("tags"))
    placed = ranked.join(t, ranked["uuid_track"] == t["_u"]).select("head", "rank", "uuid_track", "dir", "tags", F.when(F.col("dir") > 0, F.col("line")).otherwise(F.reverse("line")).alias("_l"))
    placed = placed.withColumn("_len", g.line_length("_l"))
    per = placed.groupBy("head").agg(F.array_sort(F.collect_list(F.struct("rank", "uuid_track", "dir", "_len", "_l"))).alias("_t"), F.first("tags").alias("tags"))
    line = F.expr("flatten(transform(_t, (t, i) -> CASE WHEN i = 0 THEN t._l ELSE slice(t._l, 2, greatest(size(t._l) - 1, 0)) END))")
    sums = F.expr("aggregate(_t, array(0D), (a, t) -> array_append(a, element_at(a, -1) + t._len))")
    per = per.select(uuid3(F.expr("array_join(transform(_t, t -> t.uuid_track), '|')")).alias("uuid_edge"), line.alias("line"), "_t", sums.alias("_s"), "tags")
    refs = F.expr("transform(_t, (t, i) -> named_struct('uuid_track', t.uuid_track, 'position_from', get(_s, i), 'position_to', get(_s, i + 1), 'direction', cast(t.dir AS smallint)))")
    node = lambda at: uuid3(point_key(at))
    return per.select("uuid_edge", "line", refs.alias("tracks"), node("get(line, 0)").alias("uuid_node_from"), node("element_at(line, -1)").alias("uuid_node_to"), "tags")


def assert_no_loops(edges: DataFrame) -> DataFrame:
    """`edges`, failing where an edge ends at the node it starts from."""
    loop = F.expr("CASE WHEN uuid_node_from = uuid_node_to THEN raise_error(concat('circular edge ', uuid_edge)) ELSE uuid_edge END")
    return edges.withColumn("uuid_edge", loop.cast("string"))
