"""A training corpus from `documents`: five operators, each working on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
`documents`. The last one returns the documents of the mix with the words that it takes of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackweave.llm import decontaminate, mixing, near_dedup, quality_rules, store, substring_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity of 0.8 or more)."""
    return near_dedup.keep_one(docs.select(*COLUMNS), percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start earlier elsewhere; those left without a word go."""
    cut = substring_dedup.dedup(docs.select(*COLUMNS), with_text=True)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    n_chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.char_length("kept_text").cast("long"))
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of `benchmark`."""
    return decontaminate.keep(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words that it takes of each (repeats counted)."""
    sized = docs.select(*COLUMNS, mixing.sizes().alias("size"))
    key = F.xxhash64("text", "lang", "source")
    drawn = mixing.mix(store.materialise(sized.select("doc_id", "source", "size", key.alias("_text")), "mix-sizes"))
    drawn = drawn.where("taken > 0").groupBy(F.col("doc_id").alias("_id"), "_text").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum("taken").alias("taken"), F.count("*").alias("_rows")
    )
    sized = sized.withColumn("_key", key).dropDuplicates(["doc_id", "_key"])
    both = sized.join(drawn, sized["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text")))
    return both.select(*COLUMNS, "size", "source_size", "target", "taken")


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("substring dedup", substrings),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

#: Components, repeated windows and balanced sampling are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
