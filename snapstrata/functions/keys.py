"""Keys computed from business values, so that facts need no lookup join to carry them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """YYYYMMDD as an int."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def hash_key(*values: Column) -> Column:
    """64-bit key of one or several business values; the same value has the same key in every run."""
    return F.xxhash64(*values)


def version_key(entity: Column, valid_from: Column) -> Column:
    """Key of one version of an entity."""
    return F.xxhash64(entity, valid_from.cast("string"))
