"""Connected components of a graph held in a DataFrame (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))  # u > v
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return rest.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of `edges` (a < b) with the smallest node of its component, roots left out."""
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = materialise(edges.select("a", "b").distinct(), "components")
    before = state(edges)
    while before[0]:
        edges = materialise(_small_star(_large_star(edges)), "components")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
