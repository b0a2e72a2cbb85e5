"""The estimate against a plain search for the least determinant, in groups where a start alone would mislead."""

import numpy as np
from pyspark.sql import functions as F

from snapstrata.llm import quality_outliers as Q

SHARE = 0.75


def plain_scatter(part):
    least = np.array(list(Q.LEAST.values()))
    scatter = np.cov(part.T, bias=True) / Q.shrinkage(SHARE) + np.diag(np.square(list(Q.FLOORS.values())))
    values, axes = np.linalg.eigh(scatter / np.outer(least, least))
    return (axes * np.maximum(values, 1)) @ axes.T * np.outer(least, least)


def plain_least(z, starts=60, seed=5):
    """Concentration from many random subsets; the least log determinant of all."""
    rng, best = np.random.default_rng(seed), None
    for _ in range(starts):
        part = z[rng.choice(len(z), 40, replace=False)]
        before = np.inf
        for _ in range(40):
            d = z - part.mean(0)
            d = np.einsum("ij,jk,ik->i", d, np.linalg.inv(plain_scatter(part)), d)
            part = z[d <= np.sort(d)[int(np.ceil(SHARE * len(z))) - 1]]
            now = np.linalg.slogdet(plain_scatter(part))[1]
            if now > before - 1e-9:
                break
            before = now
        if best is None or now < best[0]:
            best = (now, part.mean(0))
    return best


def test_least_determinant(spark):
    rng = np.random.default_rng(2)
    mixing = rng.normal(size=(Q.P, Q.P))
    groups = {
        "round": rng.normal(size=(300, Q.P)) * 3,
        "clusters": np.concatenate([rng.normal(size=(240, Q.P)) @ mixing, rng.normal(size=(60, Q.P)) * 0.4 + 9]),
        "hot": np.concatenate([rng.normal(size=(1500, Q.P)) * 2, rng.normal(size=(300, Q.P)) + 12]),
    }
    rows = spark.createDataFrame([("xx", name, x.tolist()) for name, z in groups.items() for x in z], "lang_key string, source_key string, z array<double>")
    pools, estimates = Q._fitted(rows, SHARE, 12, 100)
    got = {r["source_key"]: r for r in pools.join(estimates, "pool").collect()}
    for name, z in groups.items():
        want, centre = plain_least(z)
        have = -np.linalg.slogdet(np.reshape(got[name]["inverse"], (Q.P, Q.P)))[1]
        assert have <= want + 0.05, (name, have, want)
        if name != "round":
            assert np.linalg.norm(np.array(got[name]["centre"]) - centre) < 0.6


def test_steps_end_when_nothing_falls(spark, monkeypatch):
    """A group that is still after its first step takes no more of them."""
    rows = spark.createDataFrame([("xx", "s", [0.0] * Q.P) for _ in range(200)], "lang_key string, source_key string, z array<double>")
    names, kept = [], Q.stored
    monkeypatch.setattr(Q, "stored", lambda df, name: names.append(name) or kept(df, name))
    Q._fitted(rows, SHARE, 12, 100)
    assert names.count("cuts") <= 3


def test_cuts_do_not_deal_out_vectors(spark):
    """Vectors meet estimates and cuts by broadcast: only aggregates are shuffled."""
    rows = spark.range(0, 5000, 1, 4).select(F.lit("en").alias("lang_key"), F.lit("hot").alias("source_key"), F.array(*(F.rand(i) for i in range(Q.P))).alias("z"))
    seen, kept = [], Q.stored
    Q.stored, plans = (lambda df, name: seen.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, name)), seen
    try:
        Q._fitted(kept(rows, "v"), SHARE, 2, 100)
    finally:
        Q.stored = kept
    assert plans and not any("SortMergeJoin" in p for p in plans)
