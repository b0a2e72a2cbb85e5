"""Row quality: repeated keys, repeated content, rule flags, quarantine split, load gate.

Neither repeated keys nor repeated content is found with a window over the rows. A window
sorts each group in one task, which fails once a single key or text holds a large share of the
load. Both start from a grouped count, which combines before the shuffle, keep only what occurs
more than once, and join that back. The small side has a row per repeated key, so adaptive
execution can split a hot partition of the large side.

``stage`` stores a frame and reads it back. ``run`` stages the two lookups, whose size Spark then
knows, so that it broadcasts them when, and only when, they fit; and the evaluated rows, which feed
the accepted rows, the quarantine and the summary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.functions import derive
from snapstrata.functions.rules import Rule

FIRST_SEQ = "_primeira_seq"
COPIES = "_n_hash"
CONTENT_HASH = "hash_conteudo"
BLOCKED = "_bloqueado"
ORIGINAL = "_linha_original"
PACKED = "_bruto"

Stage = Callable[[DataFrame], DataFrame]


class Split:
    """Accepted rows, quarantined rows, and all rows with their flags; each is planned when asked for."""

    def __init__(self, evaluated: Callable[[], DataFrame], accepted: Callable[[], DataFrame] | None = None):
        self._evaluated = evaluated
        self._accepted = accepted

    @cached_property
    def evaluated(self) -> DataFrame:
        return self._evaluated()

    @cached_property
    def accepted(self) -> DataFrame:
        return self._accepted() if self._accepted else self.evaluated.where(~F.col(BLOCKED))

    @cached_property
    def quarantined(self) -> DataFrame:
        return self.evaluated.where(F.col(BLOCKED))


def repeated_keys(df: DataFrame, key: str, seq: str, *, within: Sequence[str] = ()) -> DataFrame:
    """Keys that occur more than once, with the lowest ``seq`` of each."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(*within, key)
        .agg(F.min(seq).alias(FIRST_SEQ), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n")
    )


def _digest_key(hash_column: str) -> Column:
    """The digest as 32 bytes, half the shuffle of its hex text.

    Never NULL, and declared so: a nullable join key makes the optimizer infer an IS NOT NULL over
    the whole content expression and rewrite it for every combination of the columns in it.
    """
    return F.coalesce(F.unhex(hash_column), F.lit(b""))


def repeated_content(df: DataFrame, hash_column: str, *, within: Sequence[str] = ()) -> DataFrame:
    """Content hashes of more than one row."""
    return (
        df.groupBy(*within, _digest_key(hash_column).alias("_resumo"))
        .agg(F.count(F.lit(1)).alias(COPIES))
        .where(F.col(COPIES) > 1)
    )


def first_occurrence(
    df: DataFrame,
    key: str,
    seq: str,
    *,
    within: Sequence[str] = (),
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Adds the lowest ``seq`` of each key that repeats (NULL for the others).

    ``seq`` has to be unique within a key. ``lookup`` is a stored ``repeated_keys``. Rows without a key find nothing; in
    a join by shuffle their ``seq`` spreads them, so that they don't meet in one partition.
    """
    if lookup is None:
        lookup = repeated_keys(df, key, seq, within=within)
    # The same for a key on either side; a constant there would be optimized away, and with it the spreading.
    wide = df.withColumn("_monte", F.when(F.col(key).isNull(), F.col(seq).cast("bigint")).otherwise(F.xxhash64(key)))
    found = lookup.withColumn("_monte", F.xxhash64(key))
    return wide.join(found, [*within, key, "_monte"], "left").select(*df.columns, FIRST_SEQ)


def content_hash(columns: Sequence[str]) -> Column:
    """Digest of a row's typed content. The column order is part of the result."""
    return derive.digest(columns, sep="|")


def clone_count(
    df: DataFrame,
    hash_column: str,
    *,
    within: Sequence[str] = (),
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Adds the number of rows that share a content hash. ``lookup`` is a stored ``repeated_content``."""
    if lookup is None:
        lookup = repeated_content(df, hash_column, within=within)
    keyed = df.withColumn("_resumo", _digest_key(hash_column))
    return keyed.join(lookup, [*within, "_resumo"], "left").select(
        *df.columns, F.coalesce(F.col(COPIES), F.lit(1)).alias(COPIES)
    )


def occurrence(
    df: DataFrame, key: str, seq: str, *, within: Sequence[str] = (), slice_width: int = 1_000_000
) -> DataFrame:
    """Adds the occurrence number of each row within its key, by ``seq`` (from 1).

    Rows of a key are cut into slices of ``slice_width`` consecutive sequence numbers. A slice
    has at most that many rows, for ``seq`` is unique, so numbering inside a slice is bounded
    whatever the key's size; the rows in earlier slices come from a grouped count. Rows without a
    key are no group: they get NULL.
    """
    group = [*within, key]
    # Whole-number division: sequences may be beyond what a double holds exactly. Rows without a key are spread by theirs.
    cut = F.call_function("div", F.col(seq), F.lit(slice_width).cast("bigint"))
    sliced = df.withColumn("_fatia", cut)
    sizes = (
        sliced.where(F.col(key).isNotNull())
        .groupBy(*group, "_fatia")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    earlier = Window.partitionBy(*group).orderBy("_fatia").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.select(*group, "_fatia", F.sum("_n").over(earlier).alias("_antes"))
        .where(F.col("_antes") > 0)
    )
    inside = F.row_number().over(Window.partitionBy(*group, "_fatia").orderBy(seq))
    keyed = sliced.where(F.col(key).isNotNull()).withColumn("_dentro", inside)
    number = F.coalesce(F.col("_antes"), F.lit(0)) + F.col("_dentro")
    numbered = keyed.join(offsets, [*group, "_fatia"], "left").select(*df.columns, number.cast("long").alias("_seq_id"))
    return numbered.unionByName(df.where(F.col(key).isNull()).withColumn("_seq_id", F.lit(None).cast("long")))


def codes(rules: Sequence[Rule]) -> Column:
    """Codes of the violated rules, in rule order; empty when none is."""
    return F.array_compact(F.array(*[F.when(F.col(r.flag), F.lit(r.code)) for r in rules]))


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One boolean per rule, never NULL, and the blocked mark."""
    flags = {r.flag: r.violated for r in rules}
    blocked = reduce(or_, [F.col(r.flag) for r in rules if r.blocks], F.lit(False))
    return df.withColumns(flags).withColumn(BLOCKED, blocked)


def packed(columns: Sequence[str]) -> Column:
    """The row as it came, to be carried along until it is known to be rejected."""
    return F.struct(*columns).alias(PACKED)


def with_original(evaluated: DataFrame) -> DataFrame:
    """The packed row as JSON where it is blocked, NULL elsewhere (JSON leaves NULL fields out)."""
    original = F.when(F.col(BLOCKED), F.to_json(PACKED))
    return evaluated.withColumn(ORIGINAL, original).drop(PACKED)


def nullify(column: str, rule: Rule) -> Column:
    """The column, or NULL where the rule is violated; the row itself stays."""
    return F.when(~F.col(rule.flag), F.col(column)).alias(column)


def split(evaluated: DataFrame) -> Split:
    """Splits a frame that carries the blocked mark."""
    return Split(lambda: evaluated)


def unblocked(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows no blocking rule rejects, by the conditions themselves instead of the stored mark."""
    return df.where(reduce(and_, [r.kept for r in rules if r.blocks], F.lit(True)))


def run(
    typed: DataFrame,
    rules: Sequence[Rule],
    *,
    key: str,
    seq: str,
    content: Sequence[str],
    within: Sequence[str] = (),
    stage: Stage | None = None,
    keys: DataFrame | None = None,
    last: Stage | None = None,
) -> Split:
    """Adds what the rules need, evaluates them, and splits. No action runs here but those of ``stage``.

    ``typed`` carries the ``packed`` raw row. Copies are counted over all rows, blocked ones
    included; so is the first occurrence, which blocks later ones even when it is itself blocked.
    ``keys`` is a stored ``repeated_keys``, for a plan that is lazy but for that lookup. ``last`` stages the evaluated
    rows in place of ``stage``, such as a write that takes their ``counts``.
    """
    store = stage or (lambda df: df)
    hashed = typed.withColumn(CONTENT_HASH, content_hash(content))
    if keys is None:
        keys = store(repeated_keys(typed, key, seq, within=within))
    copies = store(repeated_content(hashed, CONTENT_HASH, within=within))
    counted = clone_count(hashed, CONTENT_HASH, within=within, lookup=copies)
    ready = first_occurrence(counted, key, seq, within=within, lookup=keys)
    if stage is not None:
        return split((last or stage)(with_original(evaluate(ready, rules))))
    return Split(
        lambda: with_original(evaluate(ready, rules)),
        lambda: with_original(evaluate(unblocked(ready, rules), rules)),
    )


def counts(rules: Sequence[Rule]) -> dict[str, Column]:
    """Blocked rows and violations per rule, as aggregates of evaluated rows."""
    return {"bloqueadas": F.count_if(F.col(BLOCKED)), **{r.code: F.count_if(F.col(r.flag)) for r in rules}}


def summarise(evaluated: DataFrame, rules: Sequence[Rule], *, by: Sequence[str] = ()) -> DataFrame:
    """Rows, blocked rows and violations per rule in one pass."""
    measures = [F.count(F.lit(1)).alias("total"), *[c.alias(n) for n, c in counts(rules).items()]]
    return evaluated.groupBy(*by).agg(*measures)


def results(summary: DataFrame, rules: Sequence[Rule], *, by: Sequence[str] = ()) -> DataFrame:
    """The summary with a row per rule and its share of violations in percent (0 for an empty load)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(r.code).alias("regra"),
                F.lit(r.description).alias("descricao"),
                F.lit(r.severity).alias("severidade"),
                F.lit(r.action).alias("acao"),
                F.col(r.code).alias("falhas"),
            )
            for r in rules
        ]
    )
    share = F.when(F.col("total") > 0, F.col("falhas") / F.col("total") * 100.0).otherwise(F.lit(0.0))
    return summary.select(*by, "total", F.inline(rows)).select(
        *by, "regra", "descricao", "severidade", "acao", "total", "falhas", share.alias("pct_falha")
    )


def gate(summary: DataFrame, limit_pct: float) -> DataFrame:
    """Rejected share of the load in percent; the load passes up to and including the limit."""
    share = F.when(F.col("total") > 0, F.col("bloqueadas") / F.col("total") * 100.0).otherwise(F.lit(0.0))
    return summary.withColumn("pct_rejeicao", share).withColumn(
        "aprovada", F.col("pct_rejeicao") <= F.lit(float(limit_pct))
    )


class RejectionLimitExceeded(RuntimeError):
    """Too large a share of the load is in quarantine."""


def require_gate(gated: DataFrame) -> None:
    """Raises unless every load of the (one row per load) gate frame passes."""
    failed = gated.where(~F.col("aprovada")).first()
    if failed is not None:
        raise RejectionLimitExceeded(
            f"{failed['bloqueadas']}/{failed['total']} rows rejected ({failed['pct_rejeicao']:.1f}%)"
        )
