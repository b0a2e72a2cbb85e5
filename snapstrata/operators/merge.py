"""Table changes as DataFrame functions: the new content of a table from the old and a source.

All of them match on ``keys`` and expect the source to have one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds source rows whose key is not there yet; rows already there are never touched."""
    new = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], *, keep: Sequence[str] = ()
) -> DataFrame:
    """Source rows replace target rows with the same key; the others stay, new ones are added.

    Columns in ``keep`` hold their target value where the row was there before, and need not
    exist in the source.
    """
    keys = list(keys)
    if not keep:
        others = target.join(source.select(*keys), keys, "left_anti")
        return others.unionByName(source.select(*target.columns))
    marked = source.withColumn("_na_origem", F.lit(True)).alias("s")
    both = target.withColumn("_no_destino", F.lit(True)).alias("t").join(marked, keys, "full_outer")
    from_source = F.coalesce(F.col("_na_origem"), F.lit(False))
    in_target = F.coalesce(F.col("_no_destino"), F.lit(False))

    def value(column: str):
        if column in keys:
            return F.col(column)
        if column not in source.columns:
            return F.col(f"t.{column}").alias(column)
        held = in_target if column in keep else ~from_source
        return F.when(held, F.col(f"t.{column}")).otherwise(F.col(f"s.{column}")).alias(column)

    return both.select(*[value(c) for c in target.columns])


def update_columns(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], *, allowed: Sequence[str]
) -> DataFrame:
    """Sets columns of existing rows by key. A NULL in the changes means "leave as it is"."""
    keys = list(keys)
    columns = [c for c in changes.columns if c not in keys]
    refused = sorted(set(columns) - set(allowed))
    if refused:
        raise ValueError(f"columns not allowed in an update: {refused}")
    joined = target.alias("t").join(changes.alias("c"), keys, "left")

    def value(column: str):
        if column in keys:
            return F.col(column)
        old = F.col(f"t.{column}")
        new = F.coalesce(F.col(f"c.{column}"), old) if column in columns else old
        return new.alias(column)

    return joined.select(*[value(c) for c in target.columns])
