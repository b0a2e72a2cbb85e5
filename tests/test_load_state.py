"""The load state around each load: planned, registered, advanced; a run with a failing load and the run after it."""

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql.types import _parse_datatype_string
from test_dataflow import deliver, person

from snapstrata.operators import loads
from snapstrata.plans.dataflow import STATE, Warehouse
from snapstrata.sources import generations, scratch

DAYS = [date(2026, 9, n) for n in (20, 21, 22)]


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, scratch.new_path(spark, "armazem"))


def states(warehouse):
    return {r["data_carga"]: r for r in warehouse.state().collect()}


def test_two_runs_with_a_failing_load(spark, warehouse, tmp_path):
    folder = str(tmp_path)
    deliver(tmp_path, DAYS[0], [person(i) for i in range(1, 6)])
    bad = [person(1), person(2, data_cadastro="")]  # half of it rejected: the gate stops it
    deliver(tmp_path, DAYS[1], bad)
    (tmp_path / "outro.txt").write_text("x")
    first = {r["data_carga"]: r for r in warehouse.load_all(folder, "r1").collect()}
    assert (first[DAYS[0]]["status"], first[DAYS[1]]["status"]) == ("SILVER_OK", "ERRO_SILVER")
    assert (first[DAYS[0]]["linhas_bronze"], first[DAYS[0]]["linhas_silver"], first[DAYS[0]]["linhas_quarentena"]) == (5, 5, 0)
    assert "RejectionLimitExceeded" in first[DAYS[1]]["mensagem"] and first[DAYS[1]]["linhas_bronze"] == 2 and first[DAYS[1]]["linhas_silver"] is None
    assert first[DAYS[0]]["mensagem"] is None and first[DAYS[0]]["tamanho_bytes"] > 0 and first[DAYS[0]]["criado_em"] <= first[DAYS[0]]["atualizado_em"]

    # The file is sent again, mended, and one more comes; all three reach the end, the first time of each kept.
    deliver(tmp_path, DAYS[1], [person(i, salario_anual="61000") for i in range(1, 4)])
    deliver(tmp_path, DAYS[2], [person(i, salario_anual="61000") for i in range(2, 9)])
    second = {r["data_carga"]: r for r in warehouse.load_all(folder, "r2").collect()}
    assert {d: r["status"] for d, r in second.items()} == dict.fromkeys(DAYS, loads.SUCCESS)
    assert [second[d]["tentativas"] for d in DAYS] == [2, 2, 1] and [second[d]["linhas_silver"] for d in DAYS] == [5, 3, 7]
    assert second[DAYS[0]]["criado_em"] == first[DAYS[0]]["criado_em"] and second[DAYS[1]]["mensagem"] is None
    assert {r["id_cliente"]: r["count"] for r in dim_versions(warehouse).groupBy("id_cliente").count().collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 2, 6: 1, 7: 1, 8: 1}

    # Nothing is left to do: no load is touched, and a late file is refused.
    deliver(tmp_path, date(2026, 9, 1), [person(1)])
    third = {r["data_carga"]: r for r in warehouse.load_all(folder, "r3").collect()}
    assert {d: r["status"] for d, r in third.items()} == {date(2026, 9, 1): loads.OUT_OF_ORDER} and "2026-09-22" in third[date(2026, 9, 1)]["mensagem"]
    assert {d: states(warehouse)[d]["atualizado_em"] for d in DAYS} == {d: second[d]["atualizado_em"] for d in DAYS}
    assert len(list(Path(warehouse.path(STATE)).glob("geracao=*"))) == 2


def dim_versions(warehouse):
    from snapstrata.plans import customers as preset

    schema = "sk_cliente bigint, id_cliente bigint, flag_atual boolean"
    assert preset.VERSIONS.version == "sk_cliente"
    return generations.read_versions(warehouse.spark, warehouse.path("dim_cliente"), _parse_datatype_string(schema), "flag_atual")


def test_a_load_may_be_asked_for_again(spark, warehouse, tmp_path):
    folder = str(tmp_path)
    deliver(tmp_path, DAYS[0], [person(1)])
    assert [r["status"] for r in warehouse.load_all(folder, "r1").collect()] == [loads.SUCCESS]
    assert warehouse.load_all(folder, "r2", loads.Request(day=DAYS[0])).count() == 0
    again = warehouse.load_all(folder, "r3", loads.Request(day=DAYS[0], reprocess=True)).collect()
    assert [(r["status"], r["tentativas"]) for r in again] == [(loads.SUCCESS, 1)]
    with pytest.raises(loads.LoadRefused):
        warehouse.load_all(folder, "r4", loads.Request(day=DAYS[1]))


def test_files_are_chosen_inside_spark(spark, warehouse, tmp_path):
    """Case of names, other files, and files outside the wanted names, which are not even opened."""
    for day in DAYS:
        deliver(tmp_path, day, [person(1)])
    (tmp_path / f"marketing_{DAYS[1]:%Y%m%d}.csv").rename(tmp_path / f"MARKETING_{DAYS[1]:%Y%m%d}.CSV")
    (tmp_path / "marketing_20260230.csv").write_text("no day")
    done = spark.createDataFrame([(DAYS[0],)], "data_carga date")
    found = warehouse.candidates(str(tmp_path), done)
    assert {r["data_carga"]: r["impressao"] is not None for r in found.collect()} == {DAYS[1]: True, DAYS[2]: True}
    assert warehouse.candidates(str(tmp_path / "nowhere")).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and re.search(r"LeftSemi|left_semi", plan)
