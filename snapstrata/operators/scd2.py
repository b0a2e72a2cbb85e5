"""Slowly changing dimension, type 2: one row per version of an entity, with a closed date interval.

``apply_snapshot`` takes the dimension one load further; ``from_history`` builds the same rows
from all loads at once, in one shuffle. Both expect one row per entity and load, so a version
list is never longer than the number of loads.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.functions import derive, keys

FROM, TO, CURRENT = "inicio_vigencia", "fim_vigencia", "flag_atual"
OPEN_END = date(9999, 12, 31)


@dataclass(frozen=True)
class Layout:
    """Names of one versioned dimension. ``attributes`` are carried, ``tracked`` ones open a version."""

    entity: str
    version: str
    attributes: Sequence[str]
    tracked: Sequence[str]
    hash: str = "hash_atributos"

    @property
    def columns(self) -> list[str]:
        return [self.version, self.entity, *self.attributes, self.hash, FROM, TO, CURRENT]


def source(df: DataFrame, layout: Layout, *extra: str) -> DataFrame:
    """Entity, carried attributes and the digest of the tracked ones."""
    return df.select(
        layout.entity,
        *layout.attributes,
        derive.digest(layout.tracked, sep="|").alias(layout.hash),
        *extra,
    )


def apply_snapshot(dim: DataFrame, snapshot: DataFrame, day: Column, layout: Layout) -> DataFrame:
    """The dimension after the load of ``day``; ``snapshot`` is a ``source`` frame.

    A changed entity gets its version closed the day before and a new one opened. A change against
    a version that began on the same day corrects that version. Entities that are not in the load
    stay as they are. A change to a version that begins after ``day`` is an error.
    Only current versions enter the join; closed ones pass through.
    """
    current = dim.where(F.col(CURRENT)).alias("t")
    joined = current.join(snapshot.alias("s"), layout.entity, "full_outer")
    is_new = F.col(f"t.{layout.hash}").isNull()
    changed = F.col(f"t.{layout.hash}") != F.col(f"s.{layout.hash}")
    began = F.col(f"t.{FROM}")
    late = F.concat(
        F.lit("out of order: version of "), F.col(layout.entity).cast("string"),
        F.lit(" begins after the load date"),
    )

    def row(side: str, version: Column, start: Column, end: Column, current_flag: Column) -> Column:
        carried = [F.col(f"{side}.{c}").alias(c) for c in (*layout.attributes, layout.hash)]
        return F.struct(
            version.alias(layout.version),
            F.col(layout.entity).alias(layout.entity),
            *carried,
            start.alias(FROM),
            end.alias(TO),
            current_flag.alias(CURRENT),
        )

    kept = row("t", F.col(f"t.{layout.version}"), began, F.col(f"t.{TO}"), F.lit(True))
    closed = row("t", F.col(f"t.{layout.version}"), began, F.date_sub(day, 1), F.lit(False))
    corrected = row("s", F.col(f"t.{layout.version}"), began, F.col(f"t.{TO}"), F.lit(True))
    opened = row(
        "s", keys.version_key(F.col(layout.entity), day), day, F.lit(OPEN_END), F.lit(True)
    )
    outcome = (
        F.when(is_new, F.array(opened))
        .when(~F.coalesce(changed, F.lit(False)), F.array(kept))
        .when(began == day, F.array(corrected))
        .when(began < day, F.array(closed, opened))
        .otherwise(F.raise_error(late))
    )
    moved = joined.select(F.inline(outcome))
    return dim.where(~F.col(CURRENT)).select(*layout.columns).unionByName(moved)


def from_history(history: DataFrame, layout: Layout, *, day: str) -> DataFrame:
    """All versions from ``source`` rows of every load, with their load date in ``day``."""
    loads = Window.partitionBy(layout.entity).orderBy(day)
    before = F.lag(layout.hash).over(loads)
    starts = history.withColumn("_antes", before).where(
        F.col("_antes").isNull() | (F.col("_antes") != F.col(layout.hash))
    )
    following = F.lead(day).over(loads)
    return starts.withColumn("_seguinte", following).select(
        keys.version_key(F.col(layout.entity), F.col(day)).alias(layout.version),
        layout.entity,
        *layout.attributes,
        layout.hash,
        F.col(day).alias(FROM),
        F.coalesce(F.date_sub(F.col("_seguinte"), 1), F.lit(OPEN_END)).alias(TO),
        F.col("_seguinte").isNull().alias(CURRENT),
    )


def as_of(dim: DataFrame, day: Column) -> DataFrame:
    """Versions valid on a day. With a literal day both bounds reach the scan."""
    return dim.where((F.col(FROM) <= day) & (F.col(TO) >= day))


def temporal_join(df: DataFrame, dim: DataFrame, *, entity: str, day: str, columns: Sequence[str]) -> DataFrame:
    """Adds columns of the version valid on each row's own day; rows without one are left out.

    The equality on the entity partitions the join, the interval is a residual, and each row
    meets only the versions of its own entity.
    """
    versions = dim.select(
        F.col(entity).alias("_entidade"), F.col(FROM).alias("_de"), F.col(TO).alias("_ate"), *columns
    )
    inside = (F.col(entity) == F.col("_entidade")) & F.col(day).between(F.col("_de"), F.col("_ate"))
    return df.join(versions, inside, "inner").drop("_entidade", "_de", "_ate")
