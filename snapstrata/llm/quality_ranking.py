"""Quality classifier: Bradley-Terry ranking learned from pairs of documents.

A document labelled 1 is preferred to one labelled 0. The model gives each a strength, linear in its text
statistics, and the chance of a preference is the logistic function of the difference; so it is fitted by
logistic loss on feature differences. The threshold is the quantile of the strengths that leaves as large a
share of the labelled documents below it as is labelled 0; it is mapped to a score of `threshold`.

Labels are met with the documents first, by id alone. Fitting uses at most `most` documents of each label that are
there, taken by hash of their id, and `pairs` pairs of them: that bounds what the driver holds. The threshold is
taken from the strengths of all labelled documents, by one more pass over the texts whose result, an id and a number,
meets the labels. Every document is scored, each by itself, without a shuffle. Inputs are the text statistics alone.

Edge cases: null and empty texts get the score of a text without words; labels that repeat a document count
once, the higher label winning; null labels and labels without a document are left out; without documents of both labels every
score is 0.5; repeated documents each get a row; `scored` ignores further columns, `kept` returns them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import set_aside, stored
from snapstrata.llm.quality_outliers import features
from snapstrata.llm.text_stats import statistics

SEED = 7
#: Added to the spread of each feature when they are brought to one scale.
SPREADS = (0.05, 0.005, 0.004, 0.02, 0.02, 0.005, 0.005, 0.005)


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    cut: float  # the strength at the threshold

    def score(self, threshold: float) -> Column:
        logit = strength(self.weights) - self.cut + float(np.log(threshold / (1 - threshold)))
        return 1 / (1 + F.exp(-logit))


def strength(weights: tuple[float, ...]) -> Column:
    terms = [F.lit(w) * x for w, x in zip(weights, features())]
    return sum(terms[1:], terms[0])


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def bradley_terry(better: np.ndarray, worse: np.ndarray, pairs: int, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights by Newton's method on pairs drawn evenly from both sides."""
    draw = np.random.default_rng(SEED)
    x = better[draw.integers(len(better), size=pairs)] - worse[draw.integers(len(worse), size=pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / pairs + ridge * np.eye(len(w)), x.T @ (1 - p) / pairs - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fitted(docs: DataFrame, labels: DataFrame, most: int = 4000, pairs: int = 40_000) -> Model:
    there = docs.select("doc_id").distinct()
    marks = stored(
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg((F.max("quality") > 0).alias("good")).join(there, "doc_id", "left_semi"),
        "labelled",
    )
    counts = {r["good"]: r["count"] for r in marks.groupBy("good").count().collect()}
    if len(counts) < 2:
        return Model((0.0,) * len(SPREADS), float(np.log(0.3 / 0.7)))
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = marks.where("good").orderBy(*order).limit(most).unionByName(marks.where("not good").orderBy(*order).limit(most))
    # At most 2 * most ids.
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])
    rows = statistics(chosen, "good").select("good", F.array(*features()).alias("z")).collect()
    good, bad = (np.array([r["z"] for r in rows if r["good"] == k]).reshape(-1, len(SPREADS)) for k in (True, False))
    spread = np.vstack([good, bad]).std(axis=0) + np.array(SPREADS)
    weights = tuple(map(float, bradley_terry(good / spread, bad / spread, pairs) / spread))
    strengths = statistics(docs.select("doc_id", "text")).select("doc_id", strength(weights).alias("s")).join(marks, "doc_id")
    return Model(weights, cut_at(stored(strengths.groupBy("doc_id").agg(F.min("s").alias("s")), "strengths"), counts[False] / sum(counts.values())))


def cut_at(strengths: DataFrame, share: float) -> float:
    """Half way between the strength `s` that has `share` of all rows up to it and the next one (which may be none)."""
    low = strengths.agg(F.percentile_approx("s", share, 10_000)).first()[0]
    following = strengths.where(F.col("s") > low).agg(F.min("s")).first()[0]
    return (low + following) / 2 if following is not None else low


def scored(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = statistics(docs).select("doc_id", held_out().alias("held_out"), model.score(threshold).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def kept(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents predicted to be of label 1, with all their columns."""
    frame, back = set_aside(docs, "doc_id", "text")
    return back(statistics(frame, "text", *frame.columns[2:]).where(model.score(threshold) >= threshold))
