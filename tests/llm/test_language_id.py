"""The network's gradient against differences, its pooling against single texts, and held-out documents."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstrata.llm import language_id as L

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string"


def test_gradient_through_time():
    rng = np.random.default_rng(3)
    windows, labels = rng.integers(0, 256, (5, 11)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    network = L.Network(["a", "b", "c"], hidden=4)
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    _, grads = network.gradient(windows, labels)
    for name, grad in grads.items():
        w = network.weights[name]
        for at in np.argsort(-np.abs(grad).ravel())[:5]:
            at, was = np.unravel_index(at, w.shape), w[np.unravel_index(at, w.shape)]
            losses = []
            for step in (1e-3, -1e-3):
                w[at] = was + step
                losses.append(network.gradient(windows, labels)[0])
            w[at] = was
            assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(grad[at], rel=0.02, abs=1e-5), name


def test_both_directions_reach_every_position():
    """A byte changes the states behind it in one direction and those before it in the other."""
    network = L.Network(["a", "b"], hidden=4)
    x = np.full((9, 1), 65)
    y = x.copy()
    y[4] = 66
    same = {d: (network.states(x, d) == network.states(y, d)).all(axis=(1, 2)).tolist() for d in "fb"}
    assert same == {"f": [True] * 4 + [False] * 5, "b": [False] * 5 + [True] * 4}


def test_windows_hold_each_byte_once_and_pool_alike():
    rng = random.Random(4)
    texts = [bytes(rng.randrange(32, 127) for _ in range(n)) for n in (0, 1, 63, 64, 65, 200, 1000, 5000)]
    network = L.Network(["a", "b", "c"])
    together = L.pooled(network, texts)
    for text, row in zip(texts, together):
        edges = L.cuts(len(text))
        assert edges[0] == 0 and (not text or edges[-1] == len(text)) and (np.diff(edges) <= L.WINDOW).all()
        sums = sum((network.pooled(np.frombuffer(text[a:b], np.uint8)[None, :])[0] for a, b in zip(edges, edges[1:])), np.zeros(3))
        assert row == pytest.approx(sums / max(len(text), 1), abs=1e-6)
        assert row.sum() == pytest.approx(1.0 if text else 0.0, abs=1e-5)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    # A held-out document's own label changes nothing.
    hidden = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    got = L.predicted(hidden, L.fitted(hidden, steps=150)).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in truth}
    out = [r for r in got if r["held_out"]]
    assert len(out) > 20 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark):
    long = "wort und satz " * 40_000
    rows = [(None, "the cat and the dog", "en"), (1, None, "en"), (2, "", None), (3, " 12 ½ !?\n", "de"), (4, "le chat et le chien", "fr"), (4, "le chat et le chien", "fr"), (5, long, "de"), (7, "日本", None), (8, "x", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("n", "draw", "place", "held_out", "score", "bytes")})
    got = L.predicted(df, L.fitted(df, steps=20)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (1, 2, 3)} == {(i, "und", 0.0) for i in (1, 2, 3)}
    assert all(r["lang_pred"] in ("en", "fr", "de") for r in got if r["doc_id"] not in (1, 2, 3))
    assert L.predicted(df, L.fitted(df.where("false"))).select("lang_pred").distinct().collect() == [("und",)]
    one = df.where("lang is null or lang = 'fr'")
    assert {tuple(r) for r in L.predicted(one, L.fitted(one)).where("doc_id in (4, 8)").select("lang_pred", "score").collect()} == {("fr", 1.0)}
    assert L.predicted(df.where("false"), L.fitted(df, steps=1)).count() == 0


def test_the_fit_is_bounded_and_balanced(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("lang"))
    seen = {}
    original, L.trained = L.trained, lambda w, y, langs, *_: seen.update(n=Counter(y.tolist()), langs=langs)
    try:
        L.fitted(df, most=100)
    finally:
        L.trained = original
    assert seen["langs"] == ["a", "b"] and all(80 <= n <= 100 for n in seen["n"].values())
