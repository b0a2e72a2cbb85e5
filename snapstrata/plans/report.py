"""Reporting queries: aggregates over facts, then shares, deltas and fixed orders on the few result rows.

Facts are always aggregated before a share, a change or an order is worked out, so the windows
without a partition below run over one row per label or load.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.functions import derive, keys

LABEL = "rotulo"


def positioned(aggregated: DataFrame, *order: Column | str) -> DataFrame:
    """Rows in order, with their place in it; for the few rows of a report."""
    place = F.row_number().over(Window.partitionBy().orderBy(*order))
    return aggregated.withColumn("posicao", place).orderBy("posicao")


# ---------------------------------------------------------------------------- operation
def loads(state: DataFrame) -> DataFrame:
    """Load states, newest first."""
    return state.orderBy(F.col("data_carga").desc())


def top_recent(log: DataFrame, time: str, n: int, *, tie: str) -> DataFrame:
    """The latest n rows; ``tie`` decides between equal times."""
    return log.orderBy(F.col(time).desc(), F.col(tie).desc()).limit(n)


def latest_run(log: DataFrame, *, run: str, time: str, tie: str) -> DataFrame:
    """The run of the latest row, as one row."""
    return log.agg(F.max_by(run, F.struct(time, tie)).alias(run))


def of_latest_run(log: DataFrame, *, run: str, time: str, tie: str) -> DataFrame:
    """Rows of the latest run. The other side of the join is always exactly one row."""
    newest = latest_run(log, run=run, time=time, tie=tie)
    return log.join(F.broadcast(newest), run, "left_semi")


def stage_duration(log: DataFrame, *, run: str, time: str, tie: str, stage: str, seconds: str) -> DataFrame:
    """Seconds per stage of the latest run."""
    return (
        of_latest_run(log, run=run, time=time, tie=tie)
        .groupBy(stage)
        .agg(F.round(F.sum(seconds), 1).alias("seg"))
    )


def error_summary(log: DataFrame, severity: str = "severidade") -> DataFrame:
    return log.groupBy(severity).agg(F.count(F.lit(1)).alias("n"))


def load_totals(state: DataFrame) -> DataFrame:
    """Successes, errors, and the rejected share of the newest successful load."""
    ok = F.col("status") == "SUCESSO"
    newest = F.max_by(F.struct("linhas_quarentena", "linhas_bronze"), F.when(ok, F.col("data_carga")))
    totals = state.agg(
        F.count_if(ok).alias("concluidas"),
        F.count_if(F.col("status").startswith("ERRO")).alias("com_erro"),
        newest.alias("_ultima"),
    )
    share = F.try_divide(F.col("_ultima.linhas_quarentena"), F.col("_ultima.linhas_bronze"))
    return totals.select("concluidas", "com_erro", F.coalesce(share, F.lit(0.0)).alias("pct_quarentena"))


def run_succeeded(log: DataFrame, *, run: str, time: str, tie: str) -> DataFrame:
    """Whether every row of the latest run is a success."""
    rows = of_latest_run(log, run=run, time=time, tie=tie)
    return rows.groupBy(run).agg(F.bool_and(F.col("status") == "SUCESSO").alias("sucesso"))


# ---------------------------------------------------------------------------- business
def newest_two(state: DataFrame) -> DataFrame:
    """The two latest successful loads, as dates and date keys, newest first."""
    done = state.where(F.col("status") == "SUCESSO").select("data_carga")
    return done.orderBy(F.col("data_carga").desc()).limit(2).select("data_carga", keys.date_key(F.col("data_carga")).alias("sk_data_carga"))


def kpi(snapshot: DataFrame) -> DataFrame:
    """Customers, spend and five means per load.

    Means come from exact sums: added up as doubles they would depend, in their last digits, on the order of the rows.
    """
    means = {
        "ticket": "total_gasto",
        "conversao": "comprou",
        "campanhas": "qtd_campanhas_aceitas",
        "salario": "salario_anual",
        "idade": "idade",
    }
    return snapshot.groupBy("sk_data_carga").agg(
        F.count(F.lit(1)).alias("clientes"),
        F.sum("total_gasto").alias("gasto"),
        *[F.try_divide(F.sum(c).cast("double"), F.count(c)).alias(name) for name, c in means.items()],
    )


def _per_label(
    fact: DataFrame, value: str, label: str, dim: DataFrame | None, key: str | None, more: Sequence[str] = ()
) -> DataFrame:
    """Rows, known values and their sum per label, with or without a dimension that has it.

    The fact is aggregated by dimension key before the join, so what is shuffled and joined has a
    row per member: a member with a third of all rows costs no more than the others, and it does
    not matter whether the dimension is broadcast.
    """
    measures = {"_n": F.count(F.lit(1)), "_validos": F.count(value), "_soma": F.sum(value)}
    if dim is None:
        return fact.groupBy(F.col(label).alias(LABEL)).agg(*[m.alias(n) for n, m in measures.items()])
    per_key = fact.groupBy(key).agg(*[m.alias(n) for n, m in measures.items()])
    return per_key.join(dim, key, "inner").groupBy(F.col(label).alias(LABEL), *more).agg(
        *[F.sum(c).alias(c) for c in measures]
    )


def _mean() -> Column:
    """Over the known values; NULL where there is none."""
    return F.try_divide(F.col("_soma").cast("double"), F.col("_validos"))


def sum_by(fact: DataFrame, value: str, label: str, *, dim: DataFrame | None = None, key: str | None = None) -> DataFrame:
    return _per_label(fact, value, label, dim, key).select(LABEL, F.col("_soma").alias("valor"))


def rate_by(fact: DataFrame, flag: str, label: str, *, dim: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Mean and sum of a 0/1 measure over the rows that have it."""
    return _per_label(fact, flag, label, dim, key).select(LABEL, _mean().alias("valor"), F.col("_soma").alias("n"))


def count_by(fact: DataFrame, value: str, label: str, *, dim: DataFrame | None = None, key: str | None = None) -> DataFrame:
    return _per_label(fact, value, label, dim, key).select(LABEL, F.col("_n").alias("valor"), F.col("_soma").alias("gasto"))


def mean_by(
    fact: DataFrame, value: str, label: str, *more: str, dim: DataFrame | None = None, key: str | None = None
) -> DataFrame:
    """Rows and mean of the known values per label, and per further dimension columns that go with it."""
    return _per_label(fact, value, label, dim, key, more).select(LABEL, *more, F.col("_n").alias("n"), _mean().alias("valor"))


def by_version_attr(fact: DataFrame, dim: DataFrame, attribute: str, value: str, *, key: str) -> DataFrame:
    """Count and mean per attribute of the version each fact row points to."""
    return mean_by(fact, value, attribute, dim=dim.select(key, attribute), key=key)


def share_of_total(aggregated: DataFrame, value: str) -> DataFrame:
    """Adds each label's share of the total, over an already aggregated frame."""
    total = F.sum(value).over(Window.partitionBy())
    return aggregated.withColumn("fracao", F.col(value).cast("double") / total.cast("double"))


def period_delta(aggregated: DataFrame, measures: Sequence[str], *, period: str) -> DataFrame:
    """A row per period and measure with the change against the period before, in percent.

    Directions: ``sobe``, ``desce``, ``neutro`` below 0.05 %, ``sem base`` when the value before
    was 0, and NULL for the first period.
    """
    long = aggregated.select(period, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(
        [period], list(measures), "medida", "valor"
    )
    before = F.lag("valor").over(Window.partitionBy("medida").orderBy(period))
    change = (F.col("valor") - F.col("anterior")) / F.abs("anterior") * 100
    return (
        long.withColumn("anterior", before)
        .withColumn("variacao_pct", F.when(F.col("anterior") != 0, change))
        .withColumn(
            "direcao",
            F.when(F.col("anterior") == 0, "sem base")
            .when(F.abs("variacao_pct") < 0.05, "neutro")
            .when(F.col("variacao_pct") > 0, "sobe")
            .when(F.col("variacao_pct") < 0, "desce"),
        )
    )


def order_by_domain(aggregated: DataFrame, label: str, order: Mapping[str, int] | Sequence[str]) -> DataFrame:
    """Sorted by a fixed list of labels, unknown ones last however long the list is."""
    if not isinstance(order, Mapping):
        order = {name: i for i, name in enumerate(order)}
    last = max(order.values(), default=0) + 1
    return aggregated.orderBy(derive.position(F.col(label), order, unknown=last), label)


# ---------------------------------------------------------------------------- quality and catalog
def dq_latest(results: DataFrame, *, run: str = "run_id", time: str = "avaliado_ts", tie: str = "regra") -> DataFrame:
    """Rule results of the latest run, by severity and rule."""
    return of_latest_run(results, run=run, time=time, tie=tie).orderBy("severidade", "regra")


def dq_totals(results: DataFrame) -> DataFrame:
    """Blocking violations, alert rules that fired, alert rules in all."""
    blocking, alert = F.col("severidade") == "BLOQUEANTE", F.col("severidade") == "ALERTA"
    return results.agg(
        F.sum(F.when(blocking, F.col("falhas")).otherwise(0)).alias("bloqueios"),
        F.count_if(alert & (F.col("falhas") > 0)).alias("alertas_disparados"),
        F.count_if(alert).alias("alertas"),
    )


def scd_stats(dim: DataFrame, entity: str) -> DataFrame:
    """Versions, distinct entities, closed versions.

    Counted per entity first: a plain distinct count next to other aggregates would do the same
    regrouping, but per entity the second step has one row to add up.
    """
    per_entity = dim.groupBy(entity).agg(
        F.count(F.lit(1)).alias("_versoes"), F.count_if(~F.col("flag_atual")).alias("_historicas")
    )
    return per_entity.agg(
        F.coalesce(F.sum("_versoes"), F.lit(0)).alias("versoes"),
        F.count(F.lit(1)).alias("clientes"),
        F.coalesce(F.sum("_historicas"), F.lit(0)).alias("historicas"),
    )


def inventory(tables: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """Row count of every table, from name to (layer, frame); parquet answers it from footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(name).alias("tabela"), F.lit(layer).alias("camada"), "linhas"
        )
        for name, (layer, df) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def dictionary_coverage(dictionary: DataFrame) -> DataFrame:
    """Columns, documented and confidential ones per layer, and the documented share."""
    documented: Column = F.count_if(F.col("descricao") != "")
    return dictionary.groupBy("camada").agg(
        F.count(F.lit(1)).alias("colunas"),
        documented.alias("documentadas"),
        F.count_if(F.col("classificacao") == "confidencial").alias("confidenciais"),
        (documented / F.count(F.lit(1))).alias("fracao_documentada"),
    )
