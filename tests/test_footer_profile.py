"""Profiles from footers against counted ones; files without statistics, nested columns, nulls."""

import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from snapstrata.operators import catalog
from snapstrata.registry import binding

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.select("tabela", "coluna", "tipo", "linhas", "preenchidas").collect())


def counted(spark, tables):
    return sorted(r for n, (path, schema) in tables.items() for r in rows(catalog.table_profile(spark.read.schema(schema).parquet(path), n)))


@pytest.mark.parametrize("statistics", [True, False])
def test_footers_and_scans_say_the_same(spark, tmp_path, statistics):
    table = pa.table({"a": [1, None, 3], "b": ["x", None, None], "c": pa.array([[1], None, []], pa.list_(pa.int32())), "d.e": [None] * 2 + [1.5], "f": pa.array([None] * 3, pa.timestamp("us"))})
    (tmp_path / "t").mkdir()
    for i in range(3):
        pq.write_table(table, tmp_path / "t" / f"{i}.parquet", write_statistics=statistics)
    tables = {"t": (str(tmp_path / "t"), "a bigint, b string, c array<int>, `d.e` double, f timestamp_ntz")}
    got = rows(catalog.footer_profile(spark, tables))
    assert got == counted(spark, tables)
    assert {r[1]: (r[3], r[4]) for r in got} == {"a": (9, 6), "b": (9, 3), "c": (9, 6), "d.e": (9, 3), "f": (9, 0)}


def test_given_tables_without_reading_texts(spark):
    tables = {n: (f"{FOLDER}/{n}.parquet", schema) for n, schema in binding.SCHEMAS.items()}
    assert rows(catalog.footer_profile(spark, tables)) == counted(spark, tables)
    # The plan of a part: all flat columns are pushed down as counts, and this session is as it was.
    beside = catalog._footer_session(spark)
    df = beside.read.schema(binding.SCHEMAS["documents"]).parquet(f"{FOLDER}/documents.parquet")
    plan = catalog.table_profile(df, "documents")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), COUNT\(doc_id\), COUNT\(text\)", plan)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList") and isinstance(df.schema, T.StructType)
