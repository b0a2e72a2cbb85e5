from datetime import date

import pytest
from pyspark.sql import functions as F

from snapstrata.operators import loads, merge, params
from snapstrata.plans import customers as preset
from snapstrata.plans import report
from snapstrata.sources import scratch, slices

D = [date(2026, 9, d) for d in range(1, 11)]


@pytest.mark.parametrize("day", [date(2000, 2, 29), date(1999, 12, 31)])
@pytest.mark.parametrize("change", [str, str.upper, str.title])
def test_a_name_is_read_back_in_any_case(spark, day, change):
    name = spark.range(1).select(loads.expected_name(F.lit(day), "pre.fix", "txt")).first()[0]
    assert name == f"pre.fix_{day:%Y%m%d}.txt"
    df = spark.createDataFrame([(change(name),)], "n string")
    assert df.select(loads.name_date(F.col("n"), "pre.fix", "txt")).first()[0] == day


@pytest.mark.parametrize("name", ["prexfix_20000229.txt", "pre.fix_20010229.txt", "pre.fix_2000022.txt", "a pre.fix_20000229.txt", "pre.fix_20000229.txt~", "pre.fix-20000229.txt", ""])
def test_other_names_have_no_date(spark, name):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(loads.name_date(F.col("n"), "pre.fix", "txt")).first()[0] is None


def test_discovery_of_a_folder(spark, tmp_path):
    sizes = {"x_20240105.csv": 3, "x_20240104.csv": 1, "x_agora.csv": 2, "notas.txt": 9}
    for name, size in sizes.items():
        (tmp_path / name).write_bytes(b"." * size)
    files = loads.discover(spark, str(tmp_path))
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    rows = {r["arquivo"]: (r["data_carga"], r["tamanho_bytes"]) for r in loads.manifest(files, prefix="x", extension="csv").collect()}
    assert rows == {"x_20240105.csv": (date(2024, 1, 5), 3), "x_20240104.csv": (date(2024, 1, 4), 1), "x_agora.csv": (None, 2)}


def test_fingerprint_follows_content_not_order(spark):
    a = spark.createDataFrame([(str(i), str(i * i)) for i in range(500)], "x string, y string")
    b = a.orderBy(F.col("x").desc()).repartition(5)
    c = a.where("x <> '7'").unionByName(a.where("x = '8'"))

    def of(df):
        return loads.fingerprint(df, ["x", "y"]).first()[0]

    assert of(a) == of(b) and of(a) != of(c)
    assert of(a.where("false")) == "0-0-0-0-0-0"


def state(spark, rows):
    return spark.createDataFrame(rows, "data_carga date, status string, tentativas int, impressao string")


def candidates(spark, rows):
    return spark.createDataFrame(rows, "data_carga date, arquivo string, impressao string")


def planned(spark, files, known, request=loads.Request()):
    rows = loads.plan(candidates(spark, files), state(spark, known), request).collect()
    return {r["data_carga"]: (r["decisao"], r["status"], r["tentativas"], r["avisos"]) for r in rows}


def test_planning_rules(spark):
    known = [
        (D[1], "SUCESSO", 1, "a"),
        (D[2], "ERRO_SILVER", 2, "b"),
        (D[3], "ERRO_BRONZE", 3, "c"),
        (D[4], "ERRO_FORA_DE_ORDEM", 1, "d"),
        (D[5], "SUCESSO", 1, "e"),
        (D[6], "BRONZE_OK", 7, "f"),
    ]
    files = [(d, "f", h) for d, h in [(D[0], "n"), (D[1], "a"), (D[2], "b"), (D[3], "c"), (D[4], "d"), (D[6], "f"), (D[7], "a"), (D[8], "a")]]
    assert planned(spark, files, known) == {
        D[0]: ("recusar", "ERRO_FORA_DE_ORDEM", 1, ["ARQUIVO_FORA_DE_ORDEM"]),
        D[1]: ("pular", "SUCESSO", 1, []),
        D[2]: ("planejar", "PENDENTE", 3, []),
        D[3]: ("pular", "ERRO_BRONZE", 3, ["MAX_TENTATIVAS"]),
        D[4]: ("pular", "ERRO_FORA_DE_ORDEM", 1, []),
        D[6]: ("planejar", "PENDENTE", 8, []),
        D[7]: ("planejar", "PENDENTE", 1, ["ARQUIVO_CONTEUDO_DUPLICADO"]),
        D[8]: ("planejar", "PENDENTE", 1, ["ARQUIVO_CONTEUDO_DUPLICADO"]),
    }


def test_explicit_requests(spark):
    known = [(D[1], "SUCESSO", 4, "a"), (D[4], "ERRO_FORA_DE_ORDEM", 1, "d"), (D[5], "SUCESSO", 1, "e")]
    files = [(d, "f", "z") for d in D]
    assert planned(spark, files, known, loads.Request(D[5]))[D[5]][0] == "pular"
    assert planned(spark, files, known, loads.Request(D[5], reprocess=True)) == {D[5]: ("planejar", "PENDENTE", 1, [])}
    assert planned(spark, files, known, loads.Request(D[4]))[D[4]] == ("planejar", "PENDENTE", 2, [])

    def gate(request, some=files):
        s = state(spark, known)
        loads.require_plan(loads.plan(candidates(spark, some), s, request), s, request)

    gate(loads.Request(D[5], reprocess=True))
    with pytest.raises(loads.LoadRefused, match="older"):
        gate(loads.Request(D[1], reprocess=True))
    with pytest.raises(loads.LoadRefused, match="no file"):
        gate(loads.Request(D[9]), files[:3])


def test_first_plan_without_any_state(spark):
    assert planned(spark, [(D[0], "f", "a"), (D[1], "f", "a")], [])[D[0]] == ("planejar", "PENDENTE", 1, [])


def test_advance_isolates_a_failed_load(spark):
    schema = "data_carga date, status string, mensagem string, linhas_bronze bigint, linhas_silver bigint, linhas_quarentena bigint"
    now = spark.createDataFrame(
        [(D[0], "PENDENTE", None, None, None, None), (D[1], "PENDENTE", "antes", None, None, None), (D[2], "SILVER_OK", None, 5, 5, 0)], schema
    )
    outcomes = spark.createDataFrame(
        [(D[0], "bronze", True, None, 10, None, None), (D[1], "bronze", False, "x" * 5000, 3, None, None), (D[2], "bronze", True, None, 99, None, None)],
        "data_carga date, etapa string, ok boolean, mensagem string, linhas_bronze bigint, linhas_silver bigint, linhas_quarentena bigint",
    )
    got = {r["data_carga"]: r for r in loads.advance(now, outcomes).collect()}
    assert (got[D[0]]["status"], got[D[0]]["linhas_bronze"]) == ("BRONZE_OK", 10)
    assert (got[D[1]]["status"], len(got[D[1]]["mensagem"]), got[D[1]]["linhas_bronze"]) == ("ERRO_BRONZE", 5000, None)
    assert (got[D[2]]["status"], got[D[2]]["linhas_bronze"]) == ("SILVER_OK", 5)


def test_register_keeps_counts_and_first_time(spark):
    schema = "data_carga date, arquivo string, status string, tentativas int, impressao string, linhas_bronze bigint, run_id_ultimo string, mensagem string, criado_em string, atualizado_em string"
    known = spark.createDataFrame([(D[0], "f", "ERRO_SILVER", 1, "a", 10, "r0", "m", "t0", "t0")], schema)
    plan = loads.plan(candidates(spark, [(D[0], "f", "b"), (D[1], "g", "c")]), known, loads.Request())
    rows = {r["data_carga"]: r for r in loads.register(known, plan, "r1", F.lit("t1")).collect()}
    first, second = rows[D[0]], rows[D[1]]
    assert (first["status"], first["tentativas"], first["linhas_bronze"], first["criado_em"], first["atualizado_em"]) == ("PENDENTE", 2, 10, "t0", "t1")
    assert first["mensagem"] is None
    assert (second["status"], second["criado_em"], second["run_id_ultimo"]) == ("PENDENTE", "t1", "r1")


def test_update_of_a_column_that_is_not_allowed(spark):
    t = spark.createDataFrame([(1, 2, 3)], "k int, a int, b int")
    with pytest.raises(ValueError, match="'b'"):
        merge.update_columns(t, t, ["k"], allowed=["a"])


def test_empty_slice_replaces_the_old_one(spark):
    table = scratch.new_path(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    assert slices.replace_slice(df, table, D[0]) == 2
    assert slices.replace_slice(df, table, D[1]) == 2
    assert slices.replace_slice(df.where("false"), table, D[1]) == 0
    rows = slices.read_table(spark, table, df.schema)
    assert [(r["x"], r["_data_carga"]) for r in rows.orderBy("x").collect()] == [(1, D[0]), (2, D[0])]
    plan = slices.read_slice(spark, table, D[0], df.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_data_carga" in plan


def test_a_slice_is_replaced_by_its_own_rows_or_not_at_all(spark):
    table = scratch.new_path(spark, "t")
    df = spark.range(10).select(F.col("id").cast("int").alias("x"))
    slices.replace_slice(df, table, D[0])
    own = slices.read_slice(spark, table, D[0], df.schema)
    assert slices.replace_slice(own.where("x < 4"), table, D[0]) == 4
    breaks = slices.read_slice(spark, table, D[0], df.schema).select(F.when(F.col("x") < 3, F.col("x")).otherwise(F.raise_error(F.lit("dead"))).cast("int").alias("x"))
    with pytest.raises(Exception, match="dead"):
        slices.replace_slice(breaks, table, D[0])
    assert slices.read_slice(spark, table, D[0], df.schema).count() == 4


def test_results_of_two_runs_stay(spark):
    table = scratch.new_path(spark, "t")
    df = spark.createDataFrame([(1, "a")], "x int, run string")
    slices.append_part(df, table, D[0], "r1")
    slices.append_part(df.withColumn("run", F.lit("b")), table, D[0], "r2")
    slices.append_part(df.withColumn("run", F.lit("c")), table, D[0], "r2")
    assert sorted(r["run"] for r in slices.read_parts(spark, table, df.schema).collect()) == ["a", "c"]


def test_no_landing_folder_has_no_files(spark, tmp_path):
    assert loads.discover(spark, str(tmp_path / "none")).count() == 0


def test_parameters(spark):
    table = spark.createDataFrame(
        [("max_tentativas", "7", True), ("csv_separador", ",", False), ("outro", "1", True)], "parametro string, valor string, ativo boolean"
    )
    resolved = params.load_params(spark, preset.DEFAULTS, table)
    assert (resolved.get("max_tentativas", int), resolved.get("csv_separador")) == (7, ";")
    with pytest.raises(KeyError):
        resolved.get("outro")


def test_period_delta(spark):
    df = spark.createDataFrame([(1, 100.0, 0.0), (2, 110.0, 5.0), (3, 99.0, 5.0)], "p int, m double, z double")
    rows = {(r["p"], r["medida"]): (r["direcao"], r["variacao_pct"]) for r in report.period_delta(df, ["m", "z"], period="p").collect()}
    assert rows[(1, "m")] == (None, None)
    assert rows[(2, "m")] == ("sobe", 10.0) and rows[(3, "m")] == ("desce", -10.0)
    assert rows[(2, "z")] == ("sem base", None) and rows[(3, "z")] == ("neutro", 0.0)


def test_more_than_a_hundred_labels_before_an_unknown_one(spark):
    labels = [f"l{i:03}" for i in range(120)]
    df = spark.createDataFrame([("?",), *[(x,) for x in reversed(labels)]], "rotulo string")
    assert [r[0] for r in report.order_by_domain(df, "rotulo", labels).collect()] == [*labels, "?"]


def test_all_copies_of_a_load(spark):
    known = state(spark, [(d, "PENDENTE", 1, "a") for d in D[:3]] + [(D[3], "PENDENTE", 1, "b")])
    plan = loads.plan(candidates(spark, [(D[1], "f", "a"), (D[5], "g", "a"), (D[6], "h", "c")]), known, loads.Request())
    rows = {r["data_carga"]: (r["copia_de"], r["copias"]) for r in plan.collect()}
    assert rows == {D[1]: (D[0], 2), D[5]: (D[0], 3), D[6]: (None, 0)}
    named = {(r["data_carga"], r["copia"]) for r in loads.copies_of(plan, known).collect()}
    assert named == {(D[1], D[0]), (D[1], D[2]), (D[5], D[0]), (D[5], D[1]), (D[5], D[2])}


def test_means_leave_gaps_out(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("x", 0), ("y", None)], "c string, v int")
    means = {r["rotulo"]: (r["n"], r["valor"]) for r in report.mean_by(df, "v", "c").collect()}
    assert means == {"x": (3, 0.5), "y": (1, None)}
    dim = spark.createDataFrame([(1, "x"), (2, "x")], "k int, c string")
    fact = spark.createDataFrame([(1, 1), (1, None), (2, 0)], "k int, v int")
    rates = report.rate_by(fact, "v", "c", dim=dim, key="k").first()
    assert (rates["valor"], rates["n"]) == (0.5, 1)


def test_order_by_domain_puts_unknown_last(spark):
    df = spark.createDataFrame([("silver",), ("?",), ("bronze",)], "etapa string")
    assert [r[0] for r in report.order_by_domain(df, "etapa", preset.STAGE_ORDER).collect()] == ["bronze", "silver", "?"]


class Session:
    """Just enough of a session to ask for its folder."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"

    def getCheckpointDir(self):
        return None


def test_shared_folder(spark):
    assert scratch.shared_folder(Session("yarn", "hdfs:///c")) == "hdfs:///c"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session("yarn", None))
    assert scratch.shared_folder(spark) == scratch.shared_folder(spark)
