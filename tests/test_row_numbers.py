"""Row numbers that do not depend on how files are split, and rows without a key that do not meet in one partition."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapstrata.operators import quality
from snapstrata.sources import ingest


@pytest.fixture
def conf(spark):
    before = {}

    def put(**values):
        for name, value in values.items():
            name = "spark.sql." + name.replace("_", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value)


def numbers(spark, path):
    rows, _ = ingest.apply_contract(ingest.read_delimited(spark, str(path), sep=";", encoding="UTF-8"), {"ID": "id", "Texto": "texto"})
    return ingest.numbered(rows)


def test_numbers_are_places_whatever_the_splits(spark, tmp_path, conf):
    rng = random.Random(8)
    lines = [f"{rng.randint(0, 400)};{'x' * rng.randint(0, 30)}" for _ in range(3000)]
    file = tmp_path / "um.csv"
    file.write_text("\n".join(["ID;Texto", *lines[:1000], "", *lines[1000:]]) + "\n")  # blank lines are no rows
    seen, kept = [], []
    for size in ("64m", "1000", "7001"):
        conf(files_maxPartitionBytes=size, files_openCostInBytes="0")
        df = numbers(spark, file)
        seen.append({r[ingest.ROW_SEQ]: f"{r['id']};{r['texto'] or ''}" for r in df.collect()})
        first = quality.first_occurrence(df, "id", ingest.ROW_SEQ)
        kept.append({r[ingest.ROW_SEQ] for r in first.where(f"{quality.FIRST_SEQ} is null or {ingest.ROW_SEQ} = {quality.FIRST_SEQ}").collect()})
    assert seen[0] == dict(enumerate(lines)) and seen[0] == seen[1] == seen[2]
    assert kept[0] == kept[1] == kept[2] == {lines.index(x) for x in {next(y for y in lines if y.split(";")[0] == i) for i in {z.split(";")[0] for z in lines}}}


def test_files_of_a_load_follow_each_other(spark, tmp_path, conf):
    conf(files_maxPartitionBytes="300", files_openCostInBytes="0")
    for name, low, high in (("b", 100, 150), ("a", 0, 100), ("c", 150, 150), ("d", 150, 151)):
        (tmp_path / f"{name}.csv").write_text("ID;Texto\n" + "".join(f"{i};t\n" for i in range(low, high)))
    assert sorted((r[ingest.ROW_SEQ], int(r["id"])) for r in numbers(spark, tmp_path).collect()) == [(i, i) for i in range(151)]


def test_rows_without_a_key_are_spread(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive_enabled="false", shuffle_partitions="8")
    df = spark.range(0, 9000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.col("id") % 1000).alias("k"), F.col("id").alias("seq"))
    found = quality.first_occurrence(df, "k", "seq")
    placed = found.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count("*").alias("n"), F.max(quality.FIRST_SEQ))
    sizes = [r["n"] for r in placed.collect()]
    assert "SortMergeJoin" in placed._jdf.queryExecution().executedPlan().toString()
    assert max(sizes) < 2 * 9000 / 8
    rows = found.collect()
    firsts = {}
    for i in range(9000):
        if i % 3 == 0:
            firsts.setdefault(i % 1000, i)
    repeated = Counter(i % 1000 for i in range(9000) if i % 3 == 0)
    assert len(rows) == 9000
    assert all(r[quality.FIRST_SEQ] == (firsts[r["k"]] if r["k"] is not None and repeated[r["k"]] > 1 else None) for r in rows)
