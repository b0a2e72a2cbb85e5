"""Quality rules: robust outliers among documents of a language and source.

Base rules look at each text alone. Beyond them, transformed statistics of a text form a vector; the
minimum-covariance-determinant estimate of its group gives the centre and scatter of the group's regular
three quarters, and a text is rejected when its Mahalanobis distance from them is beyond `limit`.

The estimate runs as concentration steps over all rows: distances under the present estimate, their quantile
in each group, then mean and scatter of the rows below it. It starts from `STARTS` places at once (medians with the
distance of the quartiles, and moments of the rows whose hash falls in one of the others' shares), goes on from each
until the determinant of its scatter falls no more, or `steps` times, and keeps in each group the least determinant.
Each step is two aggregations that combine before they shuffle, so a group with a third of all rows costs a few rows
in the shuffle. Cuts and estimates are a row for each group and start, stored, so that Spark knows that they are small
and joins them without dealing out the vectors; texts are read once, later steps read the small table of vectors.

Edge cases: null language or source is a group of its own; groups under `least` rows (an estimate of 8 dimensions needs
some) are pooled by language, then overall, and a pool still too small for an estimate rejects nothing; null and empty texts fail the base
rule on length; repeated rows all count; directions of less spread than `LEAST` get that instead of a singular scatter;
empty tables give no rows; `judged` ignores further columns, `kept` returns them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import set_aside, stored
from snapstrata.llm.text_stats import statistics

#: Smallest standard deviation that counts as one, by feature; measured ones above it stay as they are.
LEAST = {"length": 0.25, "word_length": 0.05, "symbols": 0.04, "dup_lines": 0.1, "repeats": 0.1, "upper": 0.05, "variety": 0.05, "marks": 0.05}
#: Added to every spread only to keep the arithmetic sound, far below what counts.
FLOORS = dict.fromkeys(LEAST, 0.001)
P = len(LEAST)
#: Places that the concentration starts from, and the fall of the log determinant that counts as one.
STARTS, FALL = 3, 1e-3


def features() -> list[Column]:
    """Logs of sizes and square roots of shares, which make them roughly symmetric."""
    c = F.col
    part = lambda a, b: F.sqrt(c(a) / F.greatest(c(b), F.lit(1)))
    words = F.log1p(c("n_words").cast("double"))
    return [
        words,
        F.log1p(c("word_chars") / F.greatest(c("n_words"), F.lit(1))),
        part("n_symbols", "word_chars"),
        part("n_dup_lines", "n_lines"),
        part("n_repeat_words", "n_words"),
        part("n_upper", "n_bytes"),
        F.log1p(c("n_distinct").cast("double")) / F.greatest(words, F.lit(1.0)),
        part("n_marks", "n_bytes"),
    ]


def quantile(share: float) -> float:
    """Of chi-square with P degrees of freedom, by the Wilson-Hilferty approximation."""
    return P * (1 - 2 / (9 * P) + NormalDist().inv_cdf(share) * (2 / (9 * P)) ** 0.5) ** 3


#: Distance that one in a thousand normal rows exceeds.
LIMIT = quantile(0.999) ** 0.5


def shrinkage(share: float) -> float:
    """How much a normal scatter shrinks when only the nearest `share` of the rows count: F(q; P + 2) / share
    at the quantile q of chi-square with P degrees of freedom, by the Wilson-Hilferty approximation."""
    q, k = quantile(share), P + 2
    return NormalDist().cdf(((q / k) ** (1 / 3) - 1 + 2 / (9 * k)) / (2 / (9 * k)) ** 0.5) / share


def _distance(z: Column, centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; `inverse` has the rows of the inverse scatter one after the other."""
    d = [z[i] - centre[i] for i in range(P)]
    terms = [inverse[i * P + j] * d[i] * d[j] * (1 if i == j else 2) for i in range(P) for j in range(i, P)]
    return sum(terms[1:], terms[0])


def _estimates(moments: DataFrame, share: float) -> DataFrame:
    """Centre, inverse scatter and log determinant by group (and start), from n, sums and sums of products of its regular rows."""
    upper = np.triu_indices(P)
    floor = np.diag(np.square(list(FLOORS.values())))
    least = np.array(list(LEAST.values()))
    keys = [x for x in ("pool", "start") if x in moments.columns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for *key, n, sums, products in zip(*(frame[k] for k in keys), frame["n"], frame["sums"], frame["products"]):
                if n < 4 * P:
                    continue
                mean = np.asarray(sums, float) / n
                square = np.zeros((P, P))
                square[upper] = np.asarray(products, float) / n
                square = square + np.triu(square, 1).T
                scatter = (square - np.outer(mean, mean)) / shrinkage(share) + floor
                # In units of the least spreads, no direction has a variance under 1.
                values, axes = np.linalg.eigh(scatter / np.outer(least, least))
                scatter = (axes * np.maximum(values, 1)) @ axes.T * np.outer(least, least)
                out.append((*key, mean.tolist(), np.linalg.inv(scatter).ravel().tolist(), float(np.linalg.slogdet(scatter)[1])))
            yield pd.DataFrame(out, columns=[*keys, "centre", "inverse", "determinant"])

    kinds = {"pool": "string", "start": "int"}
    return moments.mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", centre array<double>, inverse array<double>, determinant double")


def _moments(rows: DataFrame) -> DataFrame:
    z = F.col("z")
    return rows.groupBy("pool", "start").agg(
        F.count("*").alias("n"),
        F.array(*(F.sum(z[i]) for i in range(P))).alias("sums"),
        F.array(*(F.sum(z[i] * z[j]) for i in range(P) for j in range(i, P))).alias("products"),
    )


def _vectors(docs: DataFrame, *more: str) -> DataFrame:
    """Counts, base_failed, features `z` and the group of each document (doc_id, text, lang, source, more)."""
    c = F.col
    rows = statistics(docs, "lang", "source", *more).withColumn("z", F.array(*features()))
    rows = rows.withColumn("base_failed", (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words")))
    return rows.withColumn("lang_key", F.coalesce("lang", F.lit(""))).withColumn("source_key", F.coalesce("source", F.lit("")))


def _fitted(rows: DataFrame, share: float, steps: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Pools by group, and estimates by pool."""
    c = F.col
    # Groups large enough are pools of their own; the others meet by language, then all together.
    sizes = rows.groupBy("lang_key", "source_key").agg(F.count("*").alias("n")).withColumn("own", c("n") >= least)
    small = sizes.where(~c("own")).groupBy("lang_key").agg(F.sum("n").alias("by_lang"))
    pool = F.when(c("own"), F.to_json(F.array("lang_key", "source_key"))).when(c("by_lang") >= least, F.to_json(F.array("lang_key"))).otherwise("[]")
    pools = stored(sizes.join(small, "lang_key", "left").select("lang_key", "source_key", pool.alias("pool")), "pools")
    vectors = rows.join(pools, ["lang_key", "source_key"]).select("pool", "z")

    # One start: medians, and the distance of the quartiles as spread, each feature by itself.
    middle = vectors.groupBy("pool").agg(*(F.percentile_approx(c("z")[i], [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(P)))
    diagonal = [1 / F.greatest((c(f"q{i}")[2] - c(f"q{i}")[0]) / 1.35, F.lit(v)) ** 2 for i, v in enumerate(LEAST.values())]
    medians = middle.select(
        "pool", F.lit(0).alias("start"), F.array(*(c(f"q{i}")[1] for i in range(P))).alias("centre"),
        F.array(*(diagonal[i] if i == j else F.lit(0.0) for i in range(P) for j in range(P))).alias("inverse"),
        F.lit(float("inf")).alias("determinant"),
    )
    # The others: a share of the rows each. What they estimate is not yet that of regular rows, so any determinant is a fall.
    parts = vectors.withColumn("start", (1 + F.pmod(F.xxhash64("z"), F.lit(STARTS - 1))).cast("int"))
    shares = _estimates(_moments(parts), share).withColumn("determinant", F.lit(float("inf")))
    moving, ended = stored(medians.unionByName(shares), "estimates"), []
    for _ in range(steps):
        measured = vectors.join(moving, "pool").select("pool", "start", "z", _distance(c("z"), c("centre"), c("inverse")).alias("d"))
        cuts = stored(measured.groupBy("pool", "start").agg(F.percentile_approx("d", share, 1000).alias("cut")), "cuts")
        regular = measured.join(cuts, ["pool", "start"]).where("d <= cut")
        before = moving.select("pool", "start", c("determinant").alias("before"))
        moved = stored(_estimates(_moments(regular), share).join(before, ["pool", "start"]), "estimates")
        ended.append(moved.drop("before"))
        moving = moved.where(c("determinant") < c("before") - FALL).drop("before")
        if moving.isEmpty():
            break
    least_of = F.min_by(F.struct("centre", "inverse"), F.struct("determinant", "start"))
    estimates = stored(reduce(DataFrame.unionByName, ended).groupBy("pool").agg(least_of.alias("e")).select("pool", "e.*"), "estimates")
    return pools, estimates


def _verdicts(rows: DataFrame, pools: DataFrame, estimates: DataFrame, limit: float) -> DataFrame:
    c = F.col
    judged = rows.join(pools, ["lang_key", "source_key"]).join(estimates, "pool", "left")
    judged = judged.withColumn("distance", F.sqrt(F.greatest(_distance(c("z"), c("centre"), c("inverse")), F.lit(0.0))))
    return judged.withColumn("kept", ~c("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit))


def judged(docs: DataFrame, share: float = 0.75, steps: int = 12, least: int = 100, limit: float = LIMIT) -> DataFrame:
    """doc_id, the counts, base_failed, kept and distance (null without an estimate).

    `share` of a group's rows count as regular; `limit` is the distance in standard deviations.
    """
    rows = stored(_vectors(docs.select("doc_id", "text", "lang", "source")), "vectors")
    return _verdicts(rows, *_fitted(rows, share, steps, least), limit).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def kept(docs: DataFrame, share: float = 0.75, steps: int = 12, least: int = 100, limit: float = LIMIT) -> DataFrame:
    """The documents that are kept, with all their columns. Texts are read again instead of being shuffled or stored."""
    frame, back = set_aside(docs, "doc_id", "text", "lang", "source")
    small = frame.select("doc_id", "text", "lang", "source")
    pools, estimates = _fitted(stored(_vectors(small), "vectors"), share, steps, least)
    return back(_verdicts(_vectors(frame, "text", *frame.columns[4:]), pools, estimates, limit).where("kept"))
