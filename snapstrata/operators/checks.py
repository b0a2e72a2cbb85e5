"""Reconciliation checks: each is a row of name, result and what was compared.

Counts and sums come with the writes of the tables (``sources.measured``) and are compared in one row (``compared``).
For tables whose writes nobody watched there are checks over frames, which reduce each to one row before anything
meets anything. Orphans and versions need the rows: each of these reads its table once for all its questions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.operators import scd2
from snapstrata.sources import scratch


def _check(name: str, ok: Column, detail: Column) -> list[Column]:
    return [
        F.lit(name).alias("verificacao"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
        F.coalesce(detail.cast("string"), F.lit("")).alias("detalhe"),
    ]


def _side_by_side(measures: Mapping[str, DataFrame]) -> DataFrame:
    """One-row, one-column frames next to each other in one row."""
    tagged = [
        df.toDF("_valor").select(F.lit(name).alias("_nome"), F.col("_valor").cast("decimal(38,2)"))
        for name, df in measures.items()
    ]
    return reduce(DataFrame.unionByName, tagged).agg(
        *[F.max(F.when(F.col("_nome") == name, F.col("_valor"))).alias(name) for name in measures]
    )


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)))


def _whole(column: str) -> Column:
    return F.col(column).cast("bigint").cast("string")


def load_state(name: str, state: DataFrame, expected: str) -> DataFrame:
    """The (single) load is in the expected state; no row is a failure."""
    found = state.agg(F.min("status").alias("_min"), F.max("status").alias("_max"))
    return found.select(*_check(name, (F.col("_min") == expected) & (F.col("_max") == expected), F.col("_max")))


def not_empty(name: str, df: DataFrame) -> DataFrame:
    return _count(df).toDF("n").select(*_check(name, F.col("n") > 0, F.col("n")))


def partition_complete(name: str, whole: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """The parts have as many rows together as the whole."""
    together = reduce(DataFrame.unionByName, [_count(p).toDF("n") for p in parts]).agg(F.sum("n"))
    both = _side_by_side({"a": _count(whole), "b": together})
    return both.select(*_check(name, F.col("a") == F.col("b"), F.concat_ws(" / ", _whole("a"), _whole("b"))))


def same_count(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    return multiple_of(name, left, right, 1)


def multiple_of(name: str, long: DataFrame, base: DataFrame, factor: int) -> DataFrame:
    """``long`` has ``factor`` rows for each row of ``base``."""
    both = _side_by_side({"a": _count(long), "b": _count(base)})
    ok = F.col("a") == F.col("b") * factor
    return both.select(*_check(name, ok, F.concat_ws(" / ", _whole("a"), _whole("b"))))


def same_sum(name: str, left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> DataFrame:
    both = _side_by_side(
        {"a": left.agg(F.sum(left_column)), "b": right.agg(F.sum(right_column))}
    )
    ok = F.col("a") == F.col("b")
    return both.select(*_check(name, ok, F.concat_ws(" / ", F.col("a").cast("string"), F.col("b").cast("string"))))


def _none(name: str, bad: DataFrame) -> DataFrame:
    return _count(bad).toDF("n").select(*_check(name, F.col("n") == 0, F.col("n")))


def one_current(name: str, dim: DataFrame, entity: str) -> DataFrame:
    """No entity has more than one current version."""
    current = dim.where(F.col(scd2.CURRENT)).groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    return _none(name, current.where(F.col("_n") > 1))


def valid_interval(name: str, dim: DataFrame) -> DataFrame:
    return _none(name, dim.where(F.col(scd2.FROM) > F.col(scd2.TO)))


def no_gap_or_overlap(name: str, dim: DataFrame, entity: str) -> DataFrame:
    """Each version starts the day after the one before it ends."""
    order = Window.partitionBy(entity).orderBy(scd2.FROM, scd2.TO)
    following = dim.withColumn("_seguinte", F.lead(scd2.FROM).over(order))
    return _none(name, following.where(F.col("_seguinte") != F.date_add(scd2.TO, 1)))


# ---------------------------------------------------------------------------- members of several dimensions
Roles = Mapping[str, tuple[DataFrame, str]]


def _members(dims: Roles) -> DataFrame:
    """Keys of each role; a dimension in several roles is read once."""
    roles: dict[tuple[int, str], list[str]] = {}
    frames = {}
    for column, (dim, key) in dims.items():
        roles.setdefault((id(dim), key), []).append(column)
        frames[id(dim), key] = dim
    parts = [
        frames[place].select(F.explode(F.array(*map(F.lit, columns))).alias("coluna"), F.col(place[1]).cast("bigint").alias("_chave"))
        for place, columns in roles.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _by_role(df: DataFrame, columns: Sequence[str], *also: str) -> DataFrame:
    """A row per role: its column's name and key."""
    pairs = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).cast("bigint").alias("_chave")) for c in columns])
    return df.select(F.explode(pairs).alias("_papel"), *also).select("_papel.*", *also)


def _lost(used: DataFrame, dims: Roles) -> DataFrame:
    """Roles and keys (grouped: one row each) without a member; a missing key has none."""
    return used.join(_members(dims).distinct(), ["coluna", "_chave"], "left_anti")


def orphan_keys(fact: DataFrame, dims: Roles) -> DataFrame:
    """Fact rows per fact column whose key (or lack of one) has no row in its dimension.

    ``dims`` maps a fact column to a dimension and its (whole-number) key; the same dimension may stand in several
    roles. The fact is read once: its rows become pairs of role and key, which are counted before they meet the
    members of all dimensions in one join. So a hot key reaches the join as one row.
    """
    used = _by_role(fact.select(*dims), list(dims)).groupBy("coluna", "_chave").agg(F.count(F.lit(1)).alias("_linhas"))
    lost = _lost(used, dims).groupBy("coluna").agg(F.sum("_linhas").alias("_linhas"))
    every = fact.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, dims))).alias("coluna"))
    return every.join(lost, "coluna", "left").select("coluna", F.coalesce("_linhas", F.lit(0)).cast("bigint").alias("orfas"))


def orphan_rows(fact: DataFrame, groups: Mapping[str, Roles]) -> DataFrame:
    """One row: for each named group of roles, fact rows that lack a member in any of them; such a row counts once.

    The fact is read once, for its combinations of keys and how many rows have each. Their distinct keys meet the members
    of all dimensions in one join; what is joined back to the combinations is the keys without one, few or none.
    """
    dims = {column: dim for roles in groups.values() for column, dim in roles.items()}
    sets = scratch.stored(fact.groupBy(*dims).agg(F.count(F.lit(1)).alias("_linhas")), "combinacoes")
    lost = scratch.stored(_lost(_by_role(sets, list(dims)).where(F.col("_chave").isNotNull()).distinct(), dims), "sem_membro")
    rows = sets
    for column in dims:
        keys = lost.where(F.col("coluna") == column).select(F.col("_chave").alias(f"_sem_{column}"))
        rows = rows.join(keys, F.col(column).cast("bigint") == F.col(f"_sem_{column}"), "left")
    bad = {name: reduce(or_, [F.col(c).isNull() | F.col(f"_sem_{c}").isNotNull() for c in roles]) for name, roles in groups.items()}
    return rows.agg(*[F.coalesce(F.sum(F.when(x, F.col("_linhas"))), F.lit(0)).alias(name) for name, x in bad.items()])


def orphans(name: str, fact: DataFrame, dims: Roles) -> DataFrame:
    """No fact row lacks a member in any role."""
    return orphan_rows(fact, {"n": dims}).select(*_check(name, F.col("n") == 0, F.col("n")))


def version_figures(dim: DataFrame, entity: str, version: str) -> DataFrame:
    """Faults of a versioned dimension as one row, from one pass over it.

    Entities with more than one current version, intervals that end before they begin, versions that do not start
    the day after the one before them ends, and version keys of more than one row. Rows are dealt by entity and by
    key at once; an entity has at most a version a load.
    """
    interval = F.struct(F.col(scd2.FROM), F.col(scd2.TO), F.col(scd2.CURRENT))
    nothing = F.lit(None).cast(dim.select(interval.alias("i")).schema["i"].dataType)
    dealt = dim.select(
        F.explode(F.array(
            F.struct(F.lit(True).alias("_entidade"), F.col(entity).cast("string").alias("_chave"), interval.alias("_v")),
            F.struct(F.lit(False).alias("_entidade"), F.col(version).cast("string").alias("_chave"), nothing.alias("_v")),
        )).alias("_r")
    ).select("_r.*")
    grouped = dealt.groupBy("_entidade", "_chave").agg(F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list("_v")).alias("_v"))
    v = F.col("_v")
    pairs = F.greatest(F.size(v) - 1, F.lit(0))
    breaks = F.zip_with(F.slice(v, F.lit(1), pairs), F.slice(v, F.lit(2), pairs), lambda a, b: (b[scd2.FROM] != F.date_add(a[scd2.TO], 1)).cast("int"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.coalesce(x, F.lit(0)))
    of_entity = F.col("_entidade")
    return grouped.agg(
        F.count_if(of_entity & (F.size(F.filter(v, lambda x: x[scd2.CURRENT])) > 1)).alias("atuais"),
        F.coalesce(F.sum(F.size(F.filter(v, lambda x: x[scd2.FROM] > x[scd2.TO]))), F.lit(0)).alias("invalidas"),
        F.coalesce(F.sum(total(breaks)), F.lit(0)).alias("quebras"),
        F.count_if(~of_entity & (F.col("_n") > 1)).alias("repetidas"),
    )


def unique_key(name: str, dim: DataFrame, key: str) -> DataFrame:
    """No key stands for two rows: hashed keys may collide, and a join by such a key would double rows."""
    return _none(name, dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1))


def no_failed_stage(name: str, log: DataFrame, state: DataFrame, *, run: str = "run_id", error: str = "ERRO") -> DataFrame:
    """No stage of the load's last run has failed; both frames hold the rows of that load only."""
    last = state.select(F.col("run_id_ultimo").alias(run)).distinct()
    failed = log.where(F.col("status") == error).join(last, run, "left_semi")
    return _none(name, failed)


# ---------------------------------------------------------------------------- figures taken at the write
Test = tuple[str, Column, Column]


def compared(figures: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """Tests on one row of figures (``measured.row``): nothing is read to be counted."""
    return figures.select(F.inline(F.array(*[F.struct(*_check(*t)) for t in tests])))


def some(name: str, a: str) -> Test:
    return name, F.col(a) > 0, F.col(a)


def none(name: str, a: str) -> Test:
    return name, F.col(a) == 0, F.col(a)


def adds_up(name: str, whole: str, *parts: str, times: int = 1) -> Test:
    """``whole`` is ``times`` the sum of the parts; the detail gives both, the parts' sum not multiplied."""
    together = reduce(add, [F.col(p) for p in parts])
    return name, F.col(whole) == together * times, F.concat_ws(" / ", F.col(whole).cast("string"), together.cast("string"))


def same_amount(name: str, a: str, b: str) -> Test:
    """Two sums of money agree; a sum over no rows is none, and agrees with nothing."""
    money = [F.col(x).cast("decimal(38,2)") for x in (a, b)]
    return name, money[0] == money[1], F.concat_ws(" / ", *[m.cast("string") for m in money])


def run_all(results: Sequence[DataFrame]) -> DataFrame:
    """All checks under each other."""
    return reduce(DataFrame.unionByName, results)


class CheckFailed(RuntimeError):
    """At least one reconciliation check failed."""


def require(results: DataFrame) -> None:
    failed = results.where(~F.col("ok")).orderBy("verificacao").first()
    if failed is not None:
        raise CheckFailed(f"{failed['verificacao']}: {failed['detalhe']}")
