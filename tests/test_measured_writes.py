"""Counts taken by writes, many slices in one job, pruned slice reads, and checks that read each table once."""

import random
import re
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_dataflow import D1, deliver, person

from snapstrata.operators import checks, quality, scd2
from snapstrata.plans import customers as preset
from snapstrata.plans.dataflow import Warehouse
from snapstrata.sources import measured, scratch, slices


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(df):
    return len(re.findall("FileScan parquet", plan_of(df)))


def jobs_of(spark, action, name):
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


# ---------------------------------------------------------------------------- figures
def test_figures_come_with_the_write(spark):
    df = spark.range(0, 1000, 1, 7).select("id", (F.col("id") * F.lit("0.01").cast("decimal(12,2)")).cast("decimal(12,2)").alias("v"))
    kept, figures = measured.stored(df, "m", total=F.sum("v"), pares=F.count_if(F.col("id") % 2 == 0))
    assert figures == {"linhas": 1000, "total": Decimal("4995.00"), "pares": 500} and kept.count() == 1000
    # Below a filter, in the same job: what comes in and what goes out.
    watched, seen = measured.observed(df, pares=F.count_if(F.col("id") % 2 == 0))
    _, out = measured.stored(watched.where("id < 10"), "m")
    assert (seen.get, out) == ({"linhas": 1000, "pares": 500}, {"linhas": 10})
    _, none = measured.stored(df.where("id < 0"), "m", total=F.sum("v"))
    assert none == {"linhas": 0, "total": None}


def test_a_slice_keeps_its_figures(spark, tmp_path):
    table, day = str(tmp_path / "t"), date(2026, 1, 1)
    df = spark.createDataFrame([(i, Decimal(i)) for i in range(5)], "x int, v decimal(12,2)")
    assert slices.write_slice(df, table, day, total=F.sum("v")) == {"linhas": 5, "total": Decimal("10.00")}
    read = lambda: slices.figures(spark, table, day, df.schema, total=F.sum("v"))
    assert Decimal(read()["total"]) == 10 and read()["linhas"] == 5
    # A figure that was not taken, and a version without any, are counted.
    assert slices.figures(spark, table, day, df.schema, maior=F.max("x"))["maior"] == 4
    slices.replace_slice(df.where("x < 3"), table, day)
    assert slices.figures(spark, table, day, df.schema, total=F.sum("v")) == {"linhas": 3, "total": Decimal("3.00")}
    assert slices.figures(spark, table, date(2026, 1, 2), df.schema) == {"linhas": 0}


def test_a_load_is_verified_without_reading_what_was_counted(spark, tmp_path):
    warehouse = Warehouse(spark, scratch.new_path(spark, "armazem"))
    people = [person(i) for i in range(1, 41)] + [person(99, data_cadastro="31/02/2022"), person(98, salario_anual=""), person(97, pais="")]
    file = deliver(tmp_path, D1, people)
    tables = warehouse.process(file, D1, "r1")
    names = ["bronze", "silver", "fato_cliente_snapshot", "fato_gasto_categoria", "fato_compras_canal", "fato_resposta_campanha"]
    figures = {n: warehouse._figures(n, tables[n], D1) for n in names}
    assert {n: f["linhas"] for n, f in figures.items()} == dict(zip(names, (43, 42, 42, 252, 126, 210)))
    counted = {r["regra"]: (r["total"], r["falhas"]) for r in warehouse.rule_results().collect()}
    flagged = preset.evaluate(tables["bronze"], warehouse.params).evaluated
    again = quality.results(quality.summarise(flagged, preset.ruleset(warehouse.params)), preset.ruleset(warehouse.params))
    assert counted == {r["regra"]: (r["total"], r["falhas"]) for r in again.collect()}
    # A resent load leaves equal figures.
    resent = warehouse.process(file, D1, "r2")
    assert {n: warehouse._figures(n, resent[n], D1) for n in names} == figures
    # The files of what was counted may be out of reach.
    for name in names[:2] + names[3:]:
        for part in Path(warehouse.path(name)).rglob("*.parquet"):
            part.unlink()
    verified = warehouse.verify(resent, D1)
    assert "FileScan" not in plan_of(verified) and verified.where("not ok").collect() == [] and verified.count() == 13


# ---------------------------------------------------------------------------- slices
def test_many_slices_by_one_write(spark, tmp_path):
    def years(n):
        return spark.range(0, 40 * n, 1, 6).select("id", F.make_date((2000 + F.col("id") % n).cast("int"), F.lit(1), F.lit(1)).alias("_data_carga"))

    counts = {n: jobs_of(spark, lambda n=n: slices.write_slices(years(n), str(tmp_path / f"t{n}")), f"anos-{n}") for n in (2, 12)}
    assert counts[2] == counts[12] <= 2
    table, df = str(tmp_path / "t12"), years(12)
    assert slices.days(spark, table) == [date(y, 1, 1) for y in range(2000, 2012)]
    assert slices.read_table(spark, table, df.schema).count() == 480
    # One slice from itself, one emptied, the others untouched; rows without a day are left out.
    own = slices.read_slices(spark, table, [date(2003, 1, 1)], df.schema).where("id < 50")
    more = own.unionByName(own.limit(1).withColumn("_data_carga", F.lit(None).cast("date")))
    assert slices.write_slices(more, table, emptied=[date(2005, 1, 1)])["linhas"] == own.count()
    got = Counter(r["_data_carga"].year for r in slices.read_table(spark, table, df.schema).collect())
    assert got == {**{y: 40 for y in range(2000, 2012) if y not in (2003, 2005)}, 2003: 4}
    # A single slice goes on from there.
    slices.replace_slice(df.where("id < 7"), table, date(2003, 1, 1))
    assert slices.read_slice(spark, table, date(2003, 1, 1), df.schema).count() == 7


def test_a_dead_write_of_many_slices_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.createDataFrame([(i, date(2000 + i % 5, 1, 1)) for i in range(50)], "x int, _data_carga date")
    slices.write_slices(df, table)
    dead = df.select(F.when(F.col("x") < 44, F.col("x") + 100).otherwise(F.raise_error(F.lit("dead")).cast("int")).alias("x"), "_data_carga")
    with pytest.raises(Exception, match="dead"):
        slices.write_slices(dead, table)
    read = lambda: sorted(r["x"] for r in slices.read_table(spark, table, df.schema).collect())
    assert read() == list(range(50))
    # Ended, but stopped before its markers were set: as if it had not been.
    half = df.select(F.col("x") + 100, "_data_carga").toDF("x", "_data_carga")
    half.withColumn("_versao", F.lit(2)).write.mode("append").partitionBy("_data_carga", "_versao").parquet(table)
    assert read() == list(range(50))
    slices.write_slices(half, table)
    assert read() == list(range(100, 150))


def test_a_slice_is_read_without_the_others(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    df = spark.createDataFrame([(i, date(2026, 1, 1) + timedelta(i % 20)) for i in range(100)], "x int, _data_carga date")
    slices.write_slices(df, table)
    asked, listed = slices._matching, []
    monkeypatch.setattr(slices, "_matching", lambda s, pattern: listed.append(pattern) or asked(s, pattern))
    one = slices.read_slice(spark, table, date(2026, 1, 3), df.schema)
    assert listed == [f"{table}/_data_carga=2026-01-03/_versao=*/_SUCCESS"]
    assert one.count() == 5 and all("_data_carga=2026-01-03" in f for f in one.inputFiles())
    # A join with a few days, known at run time, prunes folders.
    wanted = spark.createDataFrame([(date(2026, 1, d), "SUCESSO") for d in (2, 9)], "data_carga date, status string")
    few = scratch.stored(wanted, "estado").where("status = 'SUCESSO'").selectExpr("data_carga as _data_carga")
    joined = slices.read_table(spark, table, df.schema).join(few, "_data_carga", "left_semi")
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruningexpression\(_data_carga", plan_of(joined)) and joined.count() == 10


def test_the_newest_two_loads_prune_the_fact(spark):
    from snapstrata.registry import queries

    df = queries.kpi_newest_two(spark, "/root/testdata/sf0.001")
    assert "dynamicpruningexpression(_data_carga" in plan_of(df)


# ---------------------------------------------------------------------------- orphans and versions
@pytest.fixture
def star(spark):
    rng = random.Random(6)
    key = lambda n: rng.choice([None, *range(n)]) if rng.random() < 0.2 else 0
    rows = [(key(30), key(6), key(6)) for _ in range(2000)]
    fact = scratch.stored(spark.createDataFrame(rows, "a bigint, b int, c int"), "fatoteste")
    dim_a = scratch.stored(spark.range(25).toDF("sk"), "dima")
    dim_b = scratch.stored(spark.range(5).select(F.col("id").cast("int").alias("sk")), "dimb")
    return rows, fact, dim_a, dim_b


def test_orphans_of_all_roles_from_one_read(spark, star):
    rows, fact, dim_a, dim_b = star
    roles = {"a": (dim_a, "sk"), "b": (dim_b, "sk"), "c": (dim_b, "sk")}
    found = checks.orphan_keys(fact, roles)
    assert scans_of(found) == 3  # the fact and two dimensions, of which one has two roles
    lost = {"a": lambda x: x is None or x >= 25, "b": lambda x: x is None or x >= 5, "c": lambda x: x is None or x >= 5}
    want = {n: sum(f(r["abc".index(n)]) for r in rows) for n, f in lost.items()}
    assert {r["coluna"]: r["orfas"] for r in found.collect()} == want and all(want.values())
    groups = {"todas": roles, "datas": {k: roles[k] for k in "bc"}}
    got = checks.orphan_rows(fact, groups).first().asDict()
    assert got == {"todas": sum(lost["a"](a) or lost["b"](b) or lost["c"](c) for a, b, c in rows), "datas": sum(lost["b"](b) or lost["c"](c) for _, b, c in rows)}
    assert checks.orphan_rows(fact.where("false"), groups).first().asDict() == {"todas": 0, "datas": 0}
    assert {r["orfas"] for r in checks.orphan_keys(fact.where("false"), roles).collect()} == {0}


def test_version_faults_from_one_read(spark):
    day = lambda n: date(2026, 1, 1) + timedelta(n)
    rows = [
        (1, 10, day(0), day(4), False), (2, 10, day(5), day(9), True),  # in order
        (3, 11, day(0), day(4), True), (4, 11, day(5), day(9), True),  # two current
        (5, 12, day(0), day(4), False), (6, 12, day(6), day(9), True),  # a gap
        (7, 13, day(3), day(1), True), (8, 14, day(0), day(9), True), (8, 15, day(0), day(9), True),  # backwards; one key twice
        (9, 16, day(0), day(5), False), (10, 16, day(3), day(9), True),  # an overlap
    ]
    dim = scratch.stored(spark.createDataFrame(rows, f"sk bigint, id int, {scd2.FROM} date, {scd2.TO} date, {scd2.CURRENT} boolean"), "versoes")
    figures = checks.version_figures(dim, "id", "sk")
    assert figures.first().asDict() == {"atuais": 1, "invalidas": 1, "quebras": 2, "repetidas": 1}
    assert scans_of(figures) == 1
    assert set(checks.version_figures(dim.where("false"), "id", "sk").first()) == {0}
    # The checks that stand alone say the same.
    alone = [checks.one_current("a", dim, "id"), checks.valid_interval("b", dim), checks.no_gap_or_overlap("c", dim, "id"), checks.unique_key("d", dim, "sk")]
    assert [r["detalhe"] for r in checks.run_all(alone).collect()] == ["1", "1", "2", "1"]
