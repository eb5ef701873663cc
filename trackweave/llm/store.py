"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``: the files outlive any executor, so
a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is named (local tests)."""
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    named = tempfile.mkdtemp(prefix="trackweave-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the JVM may be gone when the interpreter ends
        pass


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back; the files go when the program ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: str = "8m") -> None:
    """Bound the Arrow batches that go to Python: rows of whole texts are large, executors may be small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def smallest(df: DataFrame, key: Column, most: int) -> DataFrame:
    """`most` rows at most, about those with the smallest hashes `key`. Rows above a bound that follows from
    the number of rows are left out first, so that no task sends `most` rows of its own."""
    n = df.count()
    if n <= most:
        return df
    bound = int(-(2**63) + 2**64 * min(1.0, (1.5 * most + 20) / n))
    return df.where(key < F.lit(min(bound, 2**63 - 1))).orderBy(key).limit(most)
