"""Labels of documents that are not there, the threshold over all labelled documents, and odd rows of `kept`."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstrata.llm import quality_ranking as Q
from snapstrata.llm.text_stats import statistics


def texts(n, seed=3):
    """Two kinds of texts that overlap: the worse one has more marks and shorter words, more or less."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bad = rng.random() < 0.4
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6 if bad else 8))) for _ in range(rng.randint(20, 90))]
        rows.append((i, " ".join(w + ("#" if rng.random() < (0.25 if bad else 0.1) else "") for w in words), int(not bad)))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = texts(600)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(4)
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, quality int")


def test_labels_of_absent_documents_change_nothing(spark, labelled):
    docs, labels = labelled
    absent = spark.range(10_000, 40_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"))
    assert Q.fitted(docs, labels.unionByName(absent), most=100) == Q.fitted(docs, labels, most=100)
    assert Q.fitted(docs, absent).weights == (0.0,) * len(Q.SPREADS)


def test_threshold_is_the_quantile_of_all_labelled_documents(spark, labelled):
    docs, labels = labelled
    model = Q.fitted(docs, labels, most=60)
    training = labels.where(~Q.held_out())
    got = statistics(docs).select("doc_id", Q.strength(model.weights).alias("s")).join(training, "doc_id").collect()
    s, bad = np.sort([r["s"] for r in got]), sum(r["quality"] == 0 for r in got)
    assert len(s) > 450 and model.cut == pytest.approx((s[bad - 1] + s[bad]) / 2, abs=1e-9)
    # As many labelled documents are predicted 0 as are labelled so.
    predicted = Q.scored(docs, model).join(training, "doc_id").where("predicted = 0").count()
    assert predicted == bad


def test_kept_with_odd_rows(spark, labelled):
    docs, labels = labelled
    model = Q.fitted(docs, labels)
    good = next(t for i, t, y in texts(600) if y == 1 and len(t) > 300)
    rows = [(1, None), (2, ""), (3, good), (3, good), (None, good), (4, good * 4000), (5, "é 日本 " * 50)]
    clash = ["score", "held_out", "s", "z", "good", "n_words", "predicted", "cut"]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in clash})
    kept = Q.kept(odd, model)
    assert kept.columns == odd.columns and {r["score"] for r in kept.collect()} <= {"x"}
    scores = Q.scored(odd, model).collect()
    want = Counter(r["doc_id"] for r in scores if r["predicted"])
    assert Counter(r["doc_id"] for r in kept.collect()) == want and len(scores) == len(rows) and want[3] in (0, 2)
    assert Q.kept(odd.where("false"), model).count() == 0 and Q.fitted(odd.where("false"), labels).weights == (0.0,) * len(Q.SPREADS)
