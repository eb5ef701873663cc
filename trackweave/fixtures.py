"""Tracks derived from the customer table by integer arithmetic, so that any engine builds the same input.

With k = c_custkey, vertex k lies at x = 20 * (k % 25), y = 20 * (k div 25), z = k * 7 % 10. Track types: chain (c),
turnout (t), crossing leg (x), third leg (y). The middle vertex is moved sideways by k % 3 - 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.ids import uuid3


def _ends(spark: SparkSession, sf_dir: str, tasks: int | None) -> DataFrame:
    k = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"))
    last = k.agg(F.max("k").alias("m"))  # one row
    k = (k.repartition(tasks) if tasks else k).join(F.broadcast(last))
    i, j = F.col("k") % 25, F.expr("k div 25")
    kinds = F.array(
        F.when((i < 24) & (F.col("k") + 1 <= F.col("m")), F.struct(F.lit("c").alias("type"), F.col("k").alias("a"), (F.col("k") + 1).alias("b"))),
        F.when((F.col("k") % 5 == 2) & (i < 24) & (F.col("k") + 26 <= F.col("m")), F.struct(F.lit("t").alias("type"), F.col("k").alias("a"), (F.col("k") + 26).alias("b"))),
        F.when((i == 12) & (j > 0), F.struct(F.lit("x").alias("type"), (F.col("k") - 26).alias("a"), F.col("k").alias("b"))),
        F.when((i == 17) & (j > 0), F.struct(F.lit("y").alias("type"), F.col("k").alias("a"), (F.col("k") - 24).alias("b"))),
    )
    return k.select("k", F.explode(F.array_compact(kinds)).alias("t")).select("k", "t.*")


def tracks(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """uuid_track, line and tags, with the type, k and the vertex numbers a and b; made by `tasks` tasks."""
    v = lambda n: f"20D * ({n} % 25) AS x, 20D * ({n} div 25) AS y, cast({n} * 7 % 10 AS double) AS z"
    t = _ends(spark, sf_dir, tasks).selectExpr("*", f"struct({v('a')}) AS _p", f"struct({v('b')}) AS _q")
    middle = "named_struct('x', (_p.x + _q.x) / 2, 'y', (_p.y + _q.y) / 2 + (k % 3) - 1, 'z', (_p.z + _q.z) / 2)"
    name = F.concat("type", F.col("k").cast("string"))
    tags = F.array_compact(F.array(F.col("type"), F.when(F.col("k") % 9 == 4, "bridge")))
    return t.select(uuid3(name).alias("uuid_track"), F.expr(f"array(_p, {middle}, _q)").alias("line"), F.array_sort(tags).alias("tags"), "type", "k", "a", "b")


#: The same tracks in DuckDB: one row per track with its three vertices (ax, ay, az, mx, ..., bz).
SQL = """
base AS (SELECT c_custkey AS k, c_custkey % 25 AS i, c_custkey // 25 AS j, max(c_custkey) OVER () AS m FROM customer),
ends AS (SELECT 'c' AS type, k, k AS a, k + 1 AS b FROM base WHERE i < 24 AND k + 1 <= m
  UNION ALL SELECT 't', k, k, k + 26 FROM base WHERE k % 5 = 2 AND i < 24 AND k + 26 <= m
  UNION ALL SELECT 'x', k, k - 26, k FROM base WHERE i = 12 AND j > 0
  UNION ALL SELECT 'y', k, k, k - 24 FROM base WHERE i = 17 AND j > 0),
flat AS (SELECT type, k, a, b, md5(type || k) AS h, 20.0::double * (a % 25) AS ax, 20.0::double * (a // 25) AS ay, (a * 7 % 10)::double AS az,
  20.0::double * (b % 25) AS bx, 20.0::double * (b // 25) AS "by", (b * 7 % 10)::double AS bz FROM ends),
tracks AS (SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-' || substr('89ab', ((instr('0123456789abcdef', substr(h, 17, 1)) - 1) & 3) + 1, 1)
    || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid_track, type, k, a, b, ax, ay, az, (ax + bx) / 2 AS mx, (ay + "by") / 2 + (k % 3) - 1 AS my, (az + bz) / 2 AS mz, bx, "by", bz,
  CASE WHEN k % 9 = 4 THEN list_sort([type, 'bridge']) ELSE [type] END AS tags FROM flat)"""
