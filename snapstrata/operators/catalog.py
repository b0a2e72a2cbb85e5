"""Data dictionary: a row per column of a set of tables, with how often it is filled.

Of stored Parquet tables the counts come from the files' footers; only columns without statistics are read.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.sources import scratch

# Sensitivity classes.
CONFIDENTIAL = "confidencial"
INTERNAL = "interno"


def _columns(totals: DataFrame, table: str, fields: list[T.StructField]) -> DataFrame:
    """One row of counts (`_linhas`, then `_c0`, `_c1`, ...) as a row per column."""
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("tabela"),
                F.lit(f.name).alias("coluna"),
                F.lit(f.dataType.simpleString()).alias("tipo"),
                F.col("_linhas").alias("linhas"),
                F.col(f"_c{i}").alias("preenchidas"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return totals.select(F.inline(rows))


def _counts(fields: list[T.StructField]) -> list[Column]:
    return [F.count(F.lit(1)).alias("_linhas"), *[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(fields)]]


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Column, type, rows and non-NULL count of one table, in one pass over it."""
    return _columns(df.agg(*_counts(df.schema.fields)), table, df.schema.fields)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet reader takes counts from footers; the given one stays as it is."""
    beside = spark.newSession()
    beside.conf.set("spark.sql.sources.useV1SourceList", "")
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside


def footer_profile(spark: SparkSession, tables: Mapping[str, tuple[str, T.StructType | str]]) -> DataFrame:
    """``table_profile`` of stored Parquet tables, from name to path and schema, without reading their flat columns.

    Nested columns are read. Where files were written without statistics all of the tables are.
    """
    beside, flat_parts, parts = _footer_session(spark), [], []
    for name, (path, schema) in tables.items():
        # A footer counts an empty list as a null, so nested columns are read, by this session's own reader.
        df, whole = beside.read.schema(schema).parquet(path), spark.read.schema(schema).parquet(path)
        nested = [f for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
        flat = [f for f in df.schema.fields if f not in nested]
        if flat:
            flat_parts.append(_columns(df.agg(*_counts(flat)), name, flat))
        if nested:
            parts.append(_columns(whole.agg(*_counts(nested)), name, nested))
    try:
        if flat_parts:
            parts.append(scratch.stored(reduce(DataFrame.unionByName, flat_parts), "perfil", spark))
        return reduce(DataFrame.unionByName, parts)
    except (Py4JJavaError, PySparkException):
        read = [table_profile(spark.read.schema(schema).parquet(path), name) for name, (path, schema) in tables.items()]
        return reduce(DataFrame.unionByName, read)


def described(
    profile: DataFrame,
    *,
    layers: Mapping[str, str],
    descriptions: Mapping[tuple[str, str], str],
    confidential: Collection[str],
) -> DataFrame:
    """A profile with layer, description ('' when there is none) and sensitivity."""
    texts = [x for (t, c), d in descriptions.items() for x in (F.lit(f"{t}.{c}"), F.lit(d))]
    layer_map = F.create_map(*[F.lit(x) for pair in layers.items() for x in pair])
    described = (
        F.coalesce(
            F.try_element_at(F.create_map(*texts), F.concat_ws(".", "tabela", "coluna")), F.lit("")
        )
        if texts
        else F.lit("")
    )
    secret = F.col("coluna").isin(list(confidential))
    return profile.select(
        "*",
        described.alias("descricao"),
        F.try_element_at(layer_map, F.col("tabela")).alias("camada"),
        F.when(secret, CONFIDENTIAL).otherwise(INTERNAL).alias("classificacao"),
    )


def dictionary(tables: Mapping[str, DataFrame], **says) -> DataFrame:
    """The profile of every table, ``described``."""
    return described(reduce(DataFrame.unionByName, [table_profile(df, name) for name, df in tables.items()]), **says)
