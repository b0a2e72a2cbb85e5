"""Quality rules as data: a code, what it does, and the conditions that break it.

A rule is a list of conditions, any of which is a violation. They stay apart so that a filter for
unbroken rows is a conjunction of small predicates: the optimizer pushes each of them to where its
one column is made. As a single predicate over many derived columns it would be rewritten for every
combination of them, which takes minutes to plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCKING = "BLOQUEANTE"
ALERT = "ALERTA"


@dataclass(frozen=True)
class Rule:
    code: str
    description: str
    severity: str
    action: str
    conditions: Sequence[Column]

    @property
    def flag(self) -> str:
        return f"_r_{self.code}"

    @property
    def blocks(self) -> bool:
        return self.severity == BLOCKING

    @property
    def violated(self) -> Column:
        return reduce(or_, [certain(c) for c in self.conditions])

    @property
    def kept(self) -> Column:
        return reduce(and_, [~certain(c) for c in self.conditions])


def certain(condition: Column) -> Column:
    """A condition that cannot be decided is no violation."""
    return F.coalesce(condition, F.lit(False))


def not_null(column: str) -> list[Column]:
    return [F.col(column).isNull()]


def all_present(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).isNull() for c in columns]


def non_negative(columns: Sequence[str]) -> list[Column]:
    return [F.col(c) < 0 for c in columns]


def max_value(column: str, limit: Any) -> list[Column]:
    return [F.col(column) > F.lit(limit)]


def in_range(column: str, low: Any, high: Column) -> list[Column]:
    """Violated by a missing value too."""
    return [F.col(column).isNull(), F.col(column) < F.lit(low), F.col(column) > high]


def not_after(column: str, limit: Column) -> list[Column]:
    return [F.col(column) > limit]


def in_domain(domains: Mapping[str, Sequence[str]]) -> list[Column]:
    """Violated when any of the columns is missing or outside its list."""
    return [~F.coalesce(F.col(c).isin(list(allowed)), F.lit(False)) for c, allowed in domains.items()]


def unique(key: str, seq: str, first_seq: str) -> list[Column]:
    """Every row of a repeated key but the first; rows without a key are left to ``not_null``.

    ``first_seq`` comes from ``quality.first_occurrence`` and is NULL for keys that occur once.
    """
    return [F.col(key).isNotNull() & (F.col(seq) > F.col(first_seq))]


def unique_content(copies: str) -> list[Column]:
    """``copies`` comes from ``quality.clone_count``: rows of the load with this content."""
    return [F.col(copies) > 1]
