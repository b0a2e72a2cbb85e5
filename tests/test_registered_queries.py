"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import rows
from snapstrata.registry.binding import TABLES

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, other, name):
    df = queries()[name](spark, FOLDER)
    got = rows(df.columns, df.collect())
    if name not in SQL:
        assert sum(got.values()) > 0
        return
    cur = other.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, cur.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
