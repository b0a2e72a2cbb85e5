"""Derived columns: row-wise totals, bands, digests, positions in a fixed list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_POSITION = 99


def row_sum(columns: Sequence[str], as_type: str, *, part_type: str | None = None) -> Column:
    """Sum across columns with NULL counted as 0; ``part_type`` casts each part first (flags to int)."""
    parts = [F.col(c).cast(part_type) if part_type else F.col(c) for c in columns]
    return reduce(add, [F.coalesce(p, F.lit(0)) for p in parts]).cast(as_type)


def band(
    value: Column,
    limits: Sequence[tuple[Any, str]],
    *,
    above: str,
    missing: str,
    upper_inclusive: bool,
) -> Column:
    """Label of the first band whose upper limit holds ``value``; limits in rising order."""
    out = F.when(value.isNull(), F.lit(missing))
    for limit, label in limits:
        inside = value <= F.lit(limit) if upper_inclusive else value < F.lit(limit)
        out = out.when(inside, F.lit(label))
    return out.otherwise(F.lit(above))


def digest(columns: Sequence[str], *, sep: str, missing: str = "<null>") -> Column:
    """SHA-256 (hex) of the columns as text, in the order given."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns]
    return F.sha2(F.concat_ws(sep, *parts), 256)


def position(value: Column, order: Mapping[str, int], *, unknown: int = UNKNOWN_POSITION) -> Column:
    """Position of a label in a fixed domain, or ``unknown``. The default is the stored value of a dimension."""
    pairs = [F.lit(x) for pair in order.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(unknown)).cast("int")


def order_by_domain(value: Column, labels: Sequence[str]) -> Column:
    """Place of a label in a list, those that are not in it behind."""
    return position(value, {label: i for i, label in enumerate(labels)}, unknown=len(labels))
