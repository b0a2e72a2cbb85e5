from datetime import date
from pathlib import Path

import pytest
from customer_rows import VALID
from pyspark.sql import functions as F

from snapstrata.operators import loads, quality, scd2
from snapstrata.plans import customers as preset
from snapstrata.plans.dataflow import Warehouse
from snapstrata.sources import generations, scratch

D1, D2 = date(2026, 9, 20), date(2026, 9, 21)


def deliver(folder, day, people):
    """A semicolon file with a byte order mark, as it is delivered."""
    lines = [";".join(preset.CONTRACT)]
    lines += [";".join({**VALID, **p}[c] for c in preset.COLUMNS) for p in people]
    path = folder / f"marketing_{day:%Y%m%d}.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8-sig")
    return str(path)


def person(i, **change):
    return {"id_cliente": str(i), "gasto_moveis": str(i), **change}


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, scratch.new_path(spark, "armazem"))


def current(dim):
    return {r["id_cliente"]: r for r in dim.where(scd2.CURRENT).collect()}


def test_two_loads_and_a_repeat(spark, warehouse, tmp_path):
    people = [person(i) for i in range(1, 31)] + [person(99, data_cadastro="31/02/2022")]
    one = warehouse.process(deliver(tmp_path, D1, people), D1, "r1")
    assert one["silver"].count() == 30
    assert warehouse.verify(one, D1).where("not ok").collect() == []

    later = [person(i, salario_anual="51000") for i in range(1, 11)] + [person(i) for i in range(11, 25)] + [person(50)]
    file = deliver(tmp_path, D2, later)
    two = warehouse.process(file, D2, "r2")
    dim = two["dim_cliente"]
    assert dim.count() == 30 + 10 + 1
    assert set(current(dim)) == {*range(1, 31), 50}
    assert warehouse.verify(two, D2).where("not ok").collect() == []
    rows = {tuple(r) for r in dim.drop("sk_cliente").collect()}

    again = warehouse.process(file, D2, "r3")
    assert {tuple(r) for r in again["dim_cliente"].drop("sk_cliente").collect()} == rows
    assert again["fato_gasto_categoria"].count() == 25 * 6
    assert again["dim_data"].count() == two["dim_data"].count()
    assert warehouse.verify(again, D2).where("not ok").collect() == []


def test_failed_gate_keeps_quarantine_but_no_accepted_rows(spark, warehouse, tmp_path):
    file = deliver(tmp_path, D1, [person(1), person(2, data_cadastro="")])
    with pytest.raises(quality.RejectionLimitExceeded):
        warehouse.process(file, D1, "r1")
    kept = spark.read.parquet(warehouse.path("quarentena"))
    assert [r["id_cliente_raw"] for r in kept.collect()] == ["2"]
    assert warehouse.rule_results().count() == 11
    with pytest.raises(quality.RejectionLimitExceeded):
        warehouse.process(file, D1, "r2")
    assert {(r["_run_id"], r["count"]) for r in warehouse.rule_results().groupBy("_run_id").count().collect()} == {("r1", 11), ("r2", 11)}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(warehouse.path("silver")).count()


def test_old_generations_and_intermediates_go(spark, warehouse, tmp_path):
    for n in range(1, 5):
        day = date(2026, 9, n)
        people = [person(i, salario_anual=str(1000 * n)) for i in range(1, 6)]
        tables = warehouse.process(deliver(tmp_path, day, people), day, f"r{n}")
    assert generations.latest(spark, warehouse.path("dim_pais")) == 4
    assert tables["dim_cliente"].count() == 20 and tables["dim_cliente"].where(scd2.CURRENT).count() == 5
    folders = lambda name: sorted(str(p.relative_to(p.parents[1])) for p in Path(warehouse.path(name)).glob("geracao=*/*=true"))
    assert folders("dim_cliente") == [f"geracao={n}/flag_atual=true" for n in (3, 4)]
    assert sorted(p.name for p in Path(warehouse.path("dim_pais")).glob("geracao=*")) == ["geracao=3", "geracao=4"]
    assert scratch._written[spark.sparkContext.applicationId] == [] or not any("base_fatos" in p for p in scratch._written[spark.sparkContext.applicationId])


def test_unfinished_generation_is_ignored_and_overwritten(spark):
    path = scratch.new_path(spark, "g")
    df = spark.range(3)
    generations.write_next(df, path, after=0)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        df.limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/geracao=2")
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert generations.latest(spark, path) == 1
    assert generations.read_latest(spark, path, df.schema).count() == 3
    assert generations.write_next(df.limit(2), path, after=1) == 2
    assert generations.read_latest(spark, path, df.schema).count() == 2


def test_folder_to_plan(spark, warehouse, tmp_path):
    deliver(tmp_path, D1, [person(1)])
    deliver(tmp_path, D2, [person(1)])
    (tmp_path / "lixo.csv").write_text("x")
    assert [r["arquivo"] for r in warehouse.badly_named(str(tmp_path)).collect()] == ["lixo.csv"]
    found = warehouse.candidates(str(tmp_path))
    print_of = found.where(F.col("data_carga") == D1).first()["impressao"]
    known = spark.createDataFrame([(D1, "SUCESSO", 1, print_of)], "data_carga date, status string, tentativas int, impressao string")
    done = known.where("status = 'SUCESSO'")
    assert [r["data_carga"] for r in warehouse.candidates(str(tmp_path), done).collect()] == [D2]
    assert warehouse.candidates(str(tmp_path), found).count() == 0
    rows = {r["data_carga"]: r for r in loads.plan(found, known, loads.Request()).collect()}
    assert rows[D1]["decisao"] == "pular"
    assert (rows[D2]["decisao"], rows[D2]["copia_de"], rows[D2]["avisos"]) == ("planejar", D1, ["ARQUIVO_CONTEUDO_DUPLICADO"])
