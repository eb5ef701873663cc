"""Mixing sources to target weights by balanced sampling (cube method).

A source that must contribute r times its words (0 <= r <= 2) gives floor(r) whole copies of each
document, and one more copy of a sample drawn with inclusion probability r - floor(r). The sample is
balanced on documents and words: the flight phase moves the vector of probabilities through the null
space of both constraints until all but two of a block are 0 or 1, large documents first, so that small ones are left. Blocks of a source fly in parallel
(a hot source is split into many by a hash); what they leave over flies again in larger company, so
that each source ends with at most two fractional documents. Landing then rounds those two so that the
source's words come nearest to the target.

Defined cases: null and empty texts have size 0 and are never needed (taken 0); null source is a
source of its own, last in order; repeated rows and repeated ids are documents of their own; an empty
table gives an empty result; columns that are not named here pass through `mix` unless they bear the
name of a result column, which replaces them. Draws come from a hash of doc_id and size, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .store import materialise

#: Production weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 4096
EPS = 1e-9


def sizes(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, n_docs, target: one row per source, so its windows run over sources only.

    With sources in the order of the level at which they meet their cap, the level that uses up the
    total is found from running sums: all sources below it get their cap, the others weight * level.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    each = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("_w", each)
    by_level = Window.orderBy((cap * F.col("source_size") / F.col("_w")), F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    per = per.withColumns(
        {
            "_total": share * F.sum("source_size").over(everything),
            "_below": F.coalesce(F.sum(cap * F.col("source_size")).over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "_rest": F.sum("_w").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    per = per.withColumn("_at", F.greatest((F.col("_total") - F.col("_below")) / F.col("_rest"), F.lit(0.0)))
    # the first source that stays under its cap sets the level of itself and of all after it
    under = F.col("_w") * F.col("_at") < cap * F.col("source_size")
    per = per.withColumn("_level", F.min(F.when(under, F.struct(F.col("_below").alias("b"), F.col("_at").alias("at")))).over(everything)["at"])
    target = F.when(F.col("_level").isNull(), cap * F.col("source_size")).otherwise(F.least(cap * F.col("source_size"), F.col("_w") * F.col("_level")))
    return per.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def fly(size: np.ndarray, p: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """The flight phase: at most two units keep a fractional probability; sums of p and of p * size stay."""
    p = p.copy()
    held: list[int] = []
    for i, x in enumerate(p):
        if not EPS < x < 1 - EPS:
            continue
        held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        sa, sb, sc = float(size[a]), float(size[b]), float(size[c])
        u = (sb - sc, sc - sa, sa - sb)  # orthogonal to (1, 1, 1) and to the sizes
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up, down = np.inf, np.inf
        for k, v in zip(held, u, strict=True):
            if v > 0:
                up, down = min(up, (1 - p[k]) / v), min(down, p[k] / v)
            elif v < 0:
                up, down = min(up, p[k] / -v), min(down, (1 - p[k]) / -v)
        step = up if draws[i] * (up + down) < down else -down
        for k, v in zip(held, u, strict=True):
            p[k] += step * v
            if p[k] < EPS:
                p[k] = 0.0
            elif p[k] > 1 - EPS:
                p[k] = 1.0
        held = [k for k in held if 0.0 < p[k] < 1.0]
    return p


def land(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Round the few units that are left so that their words come nearest to what was expected."""
    p = p.copy()
    left = [i for i, x in enumerate(p) if 0.0 < x < 1.0]
    want, docs = sum(p[i] * size[i] for i in left), sum(p[i] for i in left)
    choices = [[(m >> k) & 1 for k in range(len(left))] for m in range(1 << len(left))]
    best = min(choices, key=lambda c: (abs(sum(x * size[i] for x, i in zip(c, left, strict=True)) - want), abs(sum(c) - docs), c))
    for x, i in zip(best, left, strict=True):
        p[i] = float(x)
    return p


def _flight(last: bool):
    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="_block").sort_values(["size", "_key"], ascending=[False, True], kind="stable").reset_index(drop=True)
        size, p = pdf["size"].to_numpy(), pdf["p"].to_numpy()
        draws = (pdf["_key"].to_numpy().astype(np.uint64) >> np.uint64(11)).astype(np.float64) / 2.0**53
        p = fly(size, p, draws)
        return pdf.assign(p=land(size, p) if last else p)

    return block


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """Each row of `docs` (doc_id, source, size) with source_size, target and taken."""
    docs = docs.drop("source_size", "target", "taken", "n_docs")
    per = materialise(targets(docs, weights, share, cap), "mix-targets").withColumnRenamed("source", "_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    state = docs.join(per, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("_r", ratio)
    near = F.when(F.abs(F.col("_r") - F.round("_r")) < EPS, F.round("_r")).otherwise(F.col("_r"))
    state = state.withColumn("_r", near).withColumns(
        {
            "_whole": F.floor("_r").cast("long"),
            "p": F.when(F.col("size") > 0, F.col("_r") - F.floor("_r")).otherwise(F.lit(0.0)),
            "_key": F.xxhash64(F.lit(17), "doc_id", "size"),
            "_left": F.col("n_docs"),
        }
    )
    done = []
    largest = per.agg(F.max("n_docs")).first()[0] or 0
    while True:
        last = largest <= block
        blocks = F.greatest(F.lit(1), F.ceil(F.col("_left") / F.lit(block))).cast("long")
        dealt = state.withColumn("_block", F.pmod(F.xxhash64("_key", F.lit(len(done))), blocks))
        schema = T.StructType([f for f in dealt.schema if f.name != "_block"])
        flown = dealt.groupBy("source", "_block").applyInPandas(_flight(last), schema)
        flown = materialise(flown, "mix-flight")
        if last:
            done.append(flown)
            break
        # every block of `block` leaves two at most
        done.append(flown.where((F.col("p") == 0) | (F.col("p") == 1)))
        left = F.ceil(F.col("_left") / F.lit(block)) * 2
        state = flown.where((F.col("p") > 0) & (F.col("p") < 1)).withColumn("_left", left.cast("long"))
        largest = -(-largest // block) * 2
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.withColumn("taken", (F.col("_whole") + F.col("p").cast("long")) * F.col("size")).drop("_r", "_whole", "p", "_key", "_left", "n_docs")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = materialise(docs.select("doc_id", "source", sizes().alias("size")), "mix-sizes")
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken", "source")
