"""Every registered query that has SQL gives the same rows in DuckDB; the others run."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from trackweave import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v


def ordered(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=str)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = ordered(df.columns, df.collect())
    assert rows
    if name in catalog.ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = con.sql(catalog.ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert rows == ordered(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
