"""Every registered query with SQL against DuckDB on the smallest tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(rows):
    def one(x):
        if x is None or isinstance(x, (bool, str)):
            return x
        if isinstance(x, (int, float)):
            return None if x != x else float(x)
        return str(x)

    return sorted(repr(tuple(map(one, r))) for r in rows)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql())))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(entry.oracle_sql()[name])
    assert columns == sorted(relation.columns)
    got = normal(map(tuple, df.select(*columns).collect()))
    want = normal(relation.select(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert got == want


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["exchange", "symbol", "timestamp_m1"] and df.count() > 0
