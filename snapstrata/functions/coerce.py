"""Fail-soft typing of text columns: what cannot be read becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """One column of the typed frame.

    ``kind`` is ``text``, ``flag``, ``date``, or any Spark type name for a plain cast.
    """

    name: str
    kind: str


def text(column: str) -> Column:
    """Trimmed text; blank is NULL."""
    return F.nullif(F.trim(F.col(column)), F.lit(""))


def flag(column: str) -> Column:
    """Integer text to boolean: 1 is true, any other integer false, anything else NULL."""
    return F.trim(F.col(column)).try_cast("int") == 1


def date_text(column: str, fmt: str) -> Column:
    """Date in the given pattern; impossible or malformed dates are NULL."""
    return F.try_to_timestamp(F.trim(F.col(column)), F.lit(fmt)).cast("date")


def typed_column(field: Field, date_format: str) -> Column:
    if field.kind == "text":
        out = text(field.name)
    elif field.kind == "flag":
        out = flag(field.name)
    elif field.kind == "date":
        out = date_text(field.name, date_format)
    else:
        out = F.trim(F.col(field.name)).try_cast(field.kind)
    return out.alias(field.name)


def typed(
    df: DataFrame, fields: Sequence[Field], *, date_format: str, extra: Sequence[Column | str] = ()
) -> DataFrame:
    """One projection from text to the types of ``fields``; ``extra`` columns ride along."""
    return df.select(*[typed_column(f, date_format) for f in fields], *extra)


def default_labels(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Missing members of a dimension column get a label of their own."""
    return df.na.fill(label, subset=list(columns))
