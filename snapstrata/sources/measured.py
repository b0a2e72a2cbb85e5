"""Writes that count: figures of a frame come from the job that writes it, so nobody reads it again to be counted.

The figures are aggregates over the rows as they pass into the files. They are taken in the stage that writes, so a
task that runs again after an executor was lost counts once, as its files do: nothing that shuffles or repeats rows
may stand between the observation and the write.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapstrata.sources import scratch

#: Every set of figures has the number of rows under this name.
ROWS = "linhas"

Figures = dict[str, int | Decimal | str | None]


def observed(df: DataFrame, **measures: Column) -> tuple[DataFrame, Observation]:
    """The frame, and its figures once an action has run over it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(ROWS), *[c.alias(n) for n, c in measures.items()]), seen


def stored(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Figures]:
    """``scratch.stored`` with the figures of what was stored."""
    watched, seen = observed(df, **measures)
    return scratch.stored(watched, name), seen.get


def row(spark: SparkSession, **parts: Mapping[str, object]) -> DataFrame:
    """Figures of several writes as one row; columns are called ``<part>_<figure>``."""
    values = {f"{part}_{name}": value for part, figures in parts.items() for name, value in figures.items()}
    return spark.range(1).select(*[F.lit(v).alias(n) if v is not None else F.lit(None).cast("decimal(38,2)").alias(n) for n, v in values.items()])
