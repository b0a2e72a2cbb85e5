import random
from datetime import date, timedelta

import pytest
from customer_rows import DAY, by_id, raw
from pyspark.sql import functions as F

from snapstrata.functions import derive
from snapstrata.operators import dims, scd2
from snapstrata.plans import customers as preset

LAYOUT = scd2.Layout("id", "sk", ["a", "b"], ["a"])
DAYS = [date(2024, 1, 1) + timedelta(days=30 * i) for i in range(6)]


def clean(spark, overrides, day=DAY):
    return preset.accepted(preset.evaluate(raw(spark, overrides, day)))


def test_calendar_equals_the_standard_library(spark):
    """Every attribute of four years, a leap year and week years that begin in the year before among them."""
    params = preset.PARAMETERS.with_values(dim_data_inicio="2019-12-25", dim_data_fim="2024-01-05")
    rows = preset.calendar_dim(spark, params).collect()
    assert [r["data"] for r in sorted(rows)] == [date(2019, 12, 25) + timedelta(days=i) for i in range(len(rows))]
    for r in rows:
        d = r["data"]
        assert (r["ano"], r["mes"], r["dia"], r["ano_mes"], r["sk_data"]) == (d.year, d.month, d.day, f"{d:%Y-%m}", int(f"{d:%Y%m%d}"))
        assert (r["semestre"], r["trimestre"]) == ((d.month > 6) + 1, (d.month - 1) // 3 + 1)
        assert (r["dia_semana"], r["semana_ano"], r["fim_de_semana"]) == (d.isoweekday(), d.isocalendar().week, d.weekday() > 4)
        assert (r["nome_mes"], r["nome_dia_semana"]) == (preset.MONTHS[d.month - 1], preset.WEEKDAYS[d.weekday()])


def test_calendar_is_filled_once(spark):
    params = preset.PARAMETERS.with_values(dim_data_inicio="2026-01-01", dim_data_fim="2026-01-02")
    first = dims.calendar_if_empty(preset.calendar_dim(spark, params).where("false"), preset.calendar_dim(spark, params))
    assert first.count() == 2
    assert dims.calendar_if_empty(first, preset.calendar_dim(spark)).count() == 2


def test_dimension_grows_and_never_shrinks(spark):
    one = preset.education_dim(clean(spark, [{"escolaridade": "Doutorado"}]))
    two = preset.education_dim(clean(spark, [{"escolaridade": "Curso livre"}]))
    rows = {r["escolaridade"]: r["nivel_ordem"] for r in dims.grow(one, two, "sk_escolaridade").collect()}
    assert rows == {"Doutorado": 5, "Curso livre": 99, preset.NOT_GIVEN: 99}


def test_bands_change_at_their_limits(spark):
    steps = [(int(preset.PARAMETERS.get(f"faixa_salarial_{n}_ate")), label) for n, label in zip(("baixa", "media", "alta"), preset.INCOME_BANDS)]
    salaries = spark.createDataFrame([(v + d,) for v, _ in steps for d in (0, 1)], "salario_anual int")
    labels = [*preset.INCOME_BANDS]
    assert [r[0] for r in salaries.select(preset.income_band()).collect()] == [x for i in range(3) for x in labels[i : i + 2]]
    ages = spark.createDataFrame([(v + d,) for v, _ in preset.AGE_BANDS for d in (-1, 0)], "i int")
    labels = [*[label for _, label in preset.AGE_BANDS], preset.AGE_ABOVE]
    assert [r[0] for r in ages.select(preset.age_band(F.col("i"))).collect()] == [x for i in range(4) for x in labels[i : i + 2]]
    unknown = spark.range(1).select(preset.age_band(F.lit(None).cast("int")), preset.income_band(salary="id").isNotNull())
    assert unknown.first()[0] == preset.NOT_GIVEN


@pytest.mark.parametrize("column", preset.COLUMNS[1:])
def test_only_tracked_columns_change_the_hash(spark, column):
    other = {"data_cadastro": "4/11/2020", "estado_civil": "Casado", "escolaridade": "Mestrado"}.get(column, "1" if column != "comprou" else "0")
    other = {"campanha_2_aceita": "0", "campanha_5_aceita": "0", "qtd_compras_desconto": "7"}.get(column, other)
    rows = by_id(preset.version_source(clean(spark, [{}, {"id_cliente": "2", column: other}])))
    assert (rows[1]["hash_atributos"] != rows[2]["hash_atributos"]) == (column in preset.TRACKED)


def random_history(spark, entities=200, seed=5):
    """Entities come, go and return; their tracked attribute sometimes changes back."""
    rng = random.Random(seed)
    rows = [
        (i, day, rng.choice("xyz"), rng.choice("pq"))
        for i in range(entities)
        for day in DAYS
        if rng.random() < 0.7
    ]
    df = spark.createDataFrame(rows, "id bigint, dia date, a string, b string")
    return scd2.source(df, LAYOUT, "dia")


def apply_all(history, days=DAYS):
    dim = scd2.from_history(history.where(F.col("dia") == days[0]), LAYOUT, day="dia")
    for day in days[1:]:
        dim = scd2.apply_snapshot(dim, history.where(F.col("dia") == day).drop("dia"), F.lit(day), LAYOUT)
    return dim


def content(df):
    return sorted(map(tuple, df.select(*LAYOUT.columns).collect()))


def test_load_by_load_equals_all_at_once(spark):
    history = random_history(spark)
    assert content(apply_all(history)) == content(scd2.from_history(history, LAYOUT, day="dia"))


def test_applying_a_load_twice_changes_nothing(spark):
    history = random_history(spark, 60)
    dim = apply_all(history)
    again = scd2.apply_snapshot(
        dim, history.where(F.col("dia") == DAYS[-1]).drop("dia"), F.lit(DAYS[-1]), LAYOUT
    )
    assert content(again) == content(dim)


def versions(spark, rows):
    return scd2.source(spark.createDataFrame(rows, "id bigint, a string, b string"), LAYOUT)


def test_each_case_of_a_load(spark):
    d1, d2 = DAYS[:2]
    start = scd2.apply_snapshot(
        scd2.from_history(random_history(spark).where("false"), LAYOUT, day="dia"),
        versions(spark, [(1, "x", "p"), (2, "x", "p"), (3, "x", "p")]), F.lit(d1), LAYOUT,
    )
    after = scd2.apply_snapshot(
        start, versions(spark, [(1, "y", "p"), (2, "x", "q"), (4, "z", "p")]), F.lit(d2), LAYOUT
    )
    got = {(r["id"], r["a"], r["b"], r[scd2.FROM], r[scd2.TO], r[scd2.CURRENT]) for r in after.collect()}
    assert got == {
        (1, "x", "p", d1, d2 - timedelta(days=1), False),
        (1, "y", "p", d2, scd2.OPEN_END, True),
        (2, "x", "p", d1, scd2.OPEN_END, True),
        (3, "x", "p", d1, scd2.OPEN_END, True),
        (4, "z", "p", d2, scd2.OPEN_END, True),
    }
    fixed = scd2.apply_snapshot(after, versions(spark, [(1, "x", "q")]), F.lit(d2), LAYOUT)
    first = [r for r in fixed.collect() if r["id"] == 1]
    assert {(r["a"], r["b"], r[scd2.FROM]) for r in first} == {("x", "p", d1), ("x", "q", d2)}
    with pytest.raises(Exception, match="out of order"):
        scd2.apply_snapshot(fixed, versions(spark, [(1, "w", "q")]), F.lit(d1), LAYOUT).collect()


def test_temporal_join_picks_the_version_of_the_day(spark):
    dim = scd2.from_history(random_history(spark), LAYOUT, day="dia")
    rows = random_history(spark).select("id", "dia", F.col("hash_atributos").alias("h"))
    joined = scd2.temporal_join(rows, dim, entity="id", day="dia", columns=["hash_atributos"])
    assert joined.count() == rows.count()
    assert joined.where("h <> hash_atributos").isEmpty()


def test_as_of_bounds_reach_the_scan(spark):
    from snapstrata.sources import scratch

    dim = scratch.stored(scd2.from_history(random_history(spark), LAYOUT, day="dia"))
    plan = scd2.as_of(dim, F.lit(DAYS[2]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(inicio_vigencia), IsNotNull(fim_vigencia)" in plan.replace("\n", " ")


def test_facts_add_up_to_the_rows_they_come_from(spark):
    changes = [{"id_cliente": str(n), "gasto_alimentos": str(7 * n), "campanha_1_aceita": str(n % 2)} for n in range(1, 6)]
    rows = clean(spark, changes)
    dim = scd2.from_history(preset.version_source(rows), preset.VERSIONS, day=preset.DAY)
    facts = preset.build_facts(preset.with_version(rows, dim))
    domains = {"fato_gasto_categoria": preset.CATEGORIES, "fato_compras_canal": preset.CHANNELS, "fato_resposta_campanha": preset.CAMPAIGNS}
    assert {n: f.count() for n, f in facts.items()} == {"fato_cliente_snapshot": 5} | {n: 5 * len(d) for n, d in domains.items()}
    spent = 5 * (202 - 30) + 7 * 15
    for name, column in (("fato_cliente_snapshot", "total_gasto"), ("fato_gasto_categoria", "valor_gasto")):
        assert facts[name].agg(F.sum(column)).first()[0] == spent
    one = facts["fato_cliente_snapshot"].where("id_cliente = 3").first()
    age = DAY.year - 1968
    assert (one["sk_data_carga"], one["sk_data_cadastro"], one["idade"]) == (int(f"{DAY:%Y%m%d}"), 20201103, age)
    assert (one["total_compras"], one["qtd_campanhas_aceitas"]) == (9, 3)
    key = spark.range(1).select(F.xxhash64(F.lit("Uruguai"))).first()[0]
    assert one["sk_pais"] == key
    some = dim.where("id_cliente = 4")
    assert preset.snapshot_fact(preset.with_version(rows, some)).count() == 1


def test_position_of_unknown_labels(spark):
    df = spark.createDataFrame([("b",), ("z",)], "l string")
    assert [r[0] for r in df.select(derive.position(F.col("l"), {"a": 1, "b": 2})).collect()] == [2, 99]
