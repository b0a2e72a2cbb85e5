"""Parameters: typed defaults, and the active rows of a parameter table over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Parameters:
    """``defaults`` name every known parameter; ``values`` override some of them."""

    defaults: Mapping[str, str]
    values: Mapping[str, str] = field(default_factory=dict)

    def get(self, name: str, kind: Callable[[str], Any] = str) -> Any:
        """The value as text, or read by ``kind``; KeyError for a name that has no default."""
        default = self.defaults[name]
        return kind(self.values.get(name, default))

    def with_values(self, **values: str) -> Parameters:
        return Parameters(self.defaults, {**self.values, **values})


def resolve_params(
    defaults: DataFrame,
    table: DataFrame,
    *,
    name: str = "parametro",
    value: str = "valor",
    active: str = "ativo",
) -> DataFrame:
    """Every default, with its value replaced by the active row of the parameter table if there is one."""
    chosen = table.where(F.col(active)).select(name, F.col(value).alias("_valor_tabela"))
    return defaults.join(chosen, name, "left").withColumn(
        value, F.coalesce(F.col("_valor_tabela"), F.col(value))
    ).drop("_valor_tabela")


def load_params(spark: SparkSession, defaults: Mapping[str, str], table: DataFrame) -> Parameters:
    """The resolved parameters as an object; a parameter table has one row per known name."""
    rows = spark.createDataFrame(list(defaults.items()), "parametro string, valor string")
    resolved = resolve_params(rows, table).select("parametro", "valor").toLocalIterator()
    return Parameters(defaults, {r["parametro"]: r["valor"] for r in resolved})
