"""Facts: the version key of each row, and columns turned into rows of a domain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.functions import keys
from snapstrata.operators import scd2

CODE = "codigo"


def attach_version(
    df: DataFrame, dim: DataFrame, layout: scd2.Layout, *, day: str, columns: Sequence[str] = ()
) -> DataFrame:
    """Adds the key of the version valid on the row's load date (inner: no version, no row)."""
    return scd2.temporal_join(
        df, dim, entity=layout.entity, day=day, columns=[layout.version, *columns]
    )


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    domain: Mapping[str, str],
    *,
    value: str,
    key: str,
    as_type: str | None = None,
) -> DataFrame:
    """A row per member of ``domain`` (code to column): ids, code, key of the code, value."""
    measures = [F.col(c).cast(as_type).alias(code) if as_type else F.col(c).alias(code) for code, c in domain.items()]
    long = df.select(*ids, *measures).unpivot(list(ids), list(domain), CODE, value)
    return long.select(*ids, CODE, keys.hash_key(F.col(CODE)).alias(key), value)


def snapshot(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """A row per entity and load: keys, attributes and measures as the preset lists them."""
    return df.select(*columns)
