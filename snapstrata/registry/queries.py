"""One DataFrame per operator of the library, over the whole of the given tables.

Results hold dates as text, money as double and flags as 0/1, so that another engine's rows compare
without a type mapping.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.functions import derive, keys
from snapstrata.operators import catalog, checks, dims, loads, merge, params, quality, scd2
from snapstrata.plans import customers as preset
from snapstrata.plans import report
from snapstrata.plans.dataflow import FACT_ROWS, Warehouse, fact_measures
from snapstrata.registry import binding
from snapstrata.registry.binding import DAYS, LATEST, Defects, table
from snapstrata.sources import generations, ingest, measured, scratch, slices

DAY = ingest.LOAD_DAY
VERSIONS = preset.VERSIONS


def plain(df: DataFrame, *columns: str | Column, rename: dict[str, str] | None = None) -> DataFrame:
    """The result columns with plain types; the load date is called ``dia``."""
    picked = df.select(*columns) if columns else df
    out = []
    for f in picked.schema.fields:
        name = (rename or {}).get(f.name, {DAY: "dia", ingest.ROW_SEQ: "seq"}.get(f.name, f.name))
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(name))
    return picked.select(*out)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


# ---------------------------------------------------------------------------- shared inputs
def bronze(spark: SparkSession, folder: str, days: Sequence[date] = (LATEST,), defects: Defects = Defects()) -> DataFrame:
    """The snapshot as a stored table, which quality reads three times."""
    return scratch.stored(binding.customer_snapshots(spark, folder, days, defects), "bronze")


def checked(spark: SparkSession, folder: str, days: Sequence[date] = (LATEST,), defects: Defects = Defects()) -> quality.Split:
    return preset.evaluate(bronze(spark, folder, days, defects))


MEASURES = [
    "id_cliente", "ano_nascimento", "escolaridade", "estado_civil", "pais", "salario_anual", "qtd_filhos",
    "qtd_adolescentes", "data_cadastro", "dias_desde_ultima_compra", *preset.SPEND, "total_gasto",
    "qtd_compras_desconto", *preset.CHANNEL_COUNTS, "total_compras", "visitas_website_mes",
    *preset.CAMPAIGN_FLAGS, "qtd_campanhas_aceitas", "comprou", DAY,
]


def silver(spark: SparkSession, folder: str, days: Sequence[date] = (LATEST,), columns: Sequence[str] = MEASURES) -> DataFrame:
    """Accepted rows, lazy but for the lookup of repeated ids; without alert codes no copy is counted."""
    raw = binding.customer_snapshots(spark, folder, days)
    keys = scratch.stored(preset.repeated_ids(raw), "repetidos")
    return preset.accepted(preset.evaluate(raw, stage=None, keys=keys)).select(*columns)


def history(spark: SparkSession, folder: str, days: Sequence[date] = tuple(DAYS)) -> DataFrame:
    """Accepted rows of several loads, stored: the dimension and the facts are built from them."""
    return scratch.stored(silver(spark, folder, days), "silver")


def of_day(df: DataFrame, day: date = LATEST) -> DataFrame:
    return df.where(F.col(DAY) == F.lit(day))


def versions(clean: DataFrame) -> DataFrame:
    return scd2.from_history(preset.version_source(clean), VERSIONS, day=DAY)


def versioned(clean: DataFrame, day: date = LATEST) -> DataFrame:
    """One load with the keys of its customer versions, of which only those of that day are joined."""
    return preset.with_version(of_day(clean, day), scd2.as_of(versions(clean), F.lit(day)))


VERSION_COLUMNS = ["id_cliente", *preset.CARRIED, "hash_atributos", scd2.FROM, scd2.TO, scd2.CURRENT]


# ---------------------------------------------------------------------------- ingest and typing
def customer_snapshot(spark, folder):
    return plain(binding.customer_snapshots(spark, folder))


def contract_projection(spark, folder):
    snapshot = binding.customer_snapshots(spark, folder).drop(DAY, ingest.ROW_SEQ)
    headers = {new: old for old, new in preset.CONTRACT.items()}
    first = preset.COLUMNS[0]
    file_like = snapshot.withColumnsRenamed(
        {c: (ingest.BOM if c == first else "") + f" {headers[c]} " for c in snapshot.columns}
    ).withColumn("Coluna Extra", F.lit("x"))
    contracted, _ = ingest.apply_contract(file_like, preset.CONTRACT)
    return contracted


def audit_columns(spark, folder):
    raw = binding.customer_snapshots(spark, folder)
    data = raw.select(*preset.COLUMNS, ingest.ROW_SEQ)
    seq = F.col(ingest.ROW_SEQ)
    numbered = ingest.add_audit(
        data.select(*preset.COLUMNS, seq.alias("_s")), load_day=F.lit(LATEST), source=F.lit(f"marketing_{LATEST:%Y%m%d}.csv"),
        run_id="run-1", seq=F.col("_s"),
    )
    return plain(numbered, "id_cliente", DAY, ingest.SOURCE_FILE, ingest.RUN, ingest.ROW_SEQ)


def delimited_file(spark, folder):
    """The snapshot as a delivered file: written with the headers of the contract, read back as text, with audit columns.

    An empty text comes back as NULL, as a file does not tell the two apart.
    """
    headers = {new: old for old, new in preset.CONTRACT.items()}
    path = scratch.new_path(spark, "entrega")
    sep, encoding = preset.PARAMETERS.get("csv_separador"), preset.PARAMETERS.get("csv_encoding")
    delivered = binding.customer_snapshots(spark, folder).select(*[F.col(c).alias(headers[c]) for c in preset.COLUMNS])
    delivered.write.csv(path, header=True, sep=sep, encoding=encoding)
    rows, _ = ingest.apply_contract(ingest.read_delimited(spark, path, sep=sep, encoding=encoding), preset.CONTRACT)
    numbered = ingest.numbered(rows)
    audited = ingest.add_audit(numbered, load_day=F.lit(LATEST), source=F.lit("entrega.csv"), run_id="run-1", seq=F.col(ingest.ROW_SEQ))
    stored, figures = measured.stored(audited, "bronze")
    ingest.require_rows(figures[measured.ROWS], path)
    numbers = stored.agg(F.count_distinct(ingest.ROW_SEQ).alias("sequencias")).scalar()
    return plain(stored, *preset.COLUMNS, DAY, ingest.SOURCE_FILE, ingest.ROW_HASH, numbers.alias("sequencias"))


def load_not_empty(spark, folder):
    """Deliveries of every year of orders and of the year before the first, which is refused as it has no rows."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("ano"))
    first, last = orders.agg(F.min("ano"), F.max("ano")).first()
    target, fates = scratch.new_path(spark, "entregas"), []
    slices.write_slices(orders.withColumn(DAY, F.make_date("ano", F.lit(1), F.lit(1))), target)
    for year in range(first - 1, last + 1) if first else ():
        rows = slices.read_slice(spark, target, date(year, 1, 1), orders.schema)
        _, figures = measured.stored(rows, "entrega")
        try:
            ingest.require_rows(figures[measured.ROWS], f"entrega de {year}")
            fates.append((year, figures[measured.ROWS], "aceita"))
        except ingest.EmptyLoad:
            fates.append((year, 0, "vazia"))
    return spark.createDataFrame(fates, "ano int, linhas bigint, situacao string")


def row_numbers(spark, folder):
    """Places of the snapshot's rows in the files of a delivery that holds them in their order."""
    path = scratch.new_path(spark, "entrega")
    raw = binding.customer_snapshots(spark, folder).select(F.col("id_cliente").alias("ID"), F.col(ingest.ROW_SEQ).alias("Ordem"))
    raw.repartitionByRange("Ordem").sortWithinPartitions("Ordem").write.csv(path, header=True, sep=";")
    read = ingest.read_delimited(spark, path, sep=";", encoding="UTF-8")
    rows, _ = ingest.apply_contract(read, {"ID": "id_cliente", "Ordem": "ordem"})
    return ingest.numbered(rows).select("id_cliente", F.col("ordem").cast("bigint").alias("seq"), F.col(ingest.ROW_SEQ).alias("linha"))


def row_hash(spark, folder):
    raw = binding.customer_snapshots(spark, folder)
    return plain(raw, "id_cliente", ingest.ROW_SEQ, ingest.row_hash(preset.COLUMNS).alias("hash_linha"))


def typed_customers(spark, folder):
    out = preset.typed(binding.customer_snapshots(spark, folder))
    return plain(out.drop(quality.PACKED))


# ---------------------------------------------------------------------------- quality
def quality_accepted(spark, folder):
    return plain(preset.accepted(checked(spark, folder)))


def quality_quarantine(spark, folder):
    """With fields of the row as it came, out of its JSON."""
    rejected = preset.quarantined(checked(spark, folder))
    original = [F.get_json_object("linha_original", f"$.{c}").alias(f"original_{c}") for c in ("id_cliente", "data_cadastro", "salario_anual", "pais")]
    return plain(rejected.select("*", *original).drop("linha_original"))


def _rule_results(spark, folder) -> DataFrame:
    rules = preset.ruleset()
    summary = quality.summarise(checked(spark, folder, DAYS).evaluated, rules, by=[DAY])
    return quality.results(summary, rules, by=[DAY])


def quality_summary(spark, folder):
    return rounded(plain(_rule_results(spark, folder).drop("descricao")), "pct_falha")


def quality_gate(spark, folder):
    rules = preset.ruleset()
    limit = preset.PARAMETERS.get("limite_rejeicao_pct", float)
    parts = []
    for name, defects in (("normal", Defects()), ("suja", Defects().dirtier())):
        raw = binding.customer_snapshots(spark, folder, (LATEST,), defects)
        flagged = preset.evaluate(raw, stage=None).evaluated
        gated = quality.gate(quality.summarise(flagged, rules), limit)
        parts.append(gated.select(F.lit(name).alias("carga"), "total", "bloqueadas", "pct_rejeicao", "aprovada"))
    return rounded(plain(parts[0].unionByName(parts[1])), "pct_rejeicao")


def content_clones(spark, folder):
    typed = preset.typed(bronze(spark, folder)).withColumn(
        quality.CONTENT_HASH, quality.content_hash(preset.CONTENT)
    )
    counted = quality.clone_count(typed, quality.CONTENT_HASH, within=[DAY])
    return plain(
        counted, ingest.ROW_SEQ, quality.CONTENT_HASH, quality.COPIES, rename={quality.COPIES: "copias"}
    )


def first_occurrence(spark, folder):
    typed = preset.typed(binding.customer_snapshots(spark, folder)).select("id_cliente", DAY, ingest.ROW_SEQ)
    found = quality.first_occurrence(typed, "id_cliente", ingest.ROW_SEQ, within=[DAY])
    repeated = F.coalesce(F.col(ingest.ROW_SEQ) > F.col(quality.FIRST_SEQ), F.lit(False))
    return plain(found, "id_cliente", ingest.ROW_SEQ, repeated.alias("repetida"))


def occurrence_number(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id")
    return quality.occurrence(events, "user_id", "event_id").withColumnRenamed("_seq_id", "vez")


# ---------------------------------------------------------------------------- dimensions
def calendar(spark, folder):
    days = table(spark, folder, "orders").agg(
        F.min("o_orderdate").cast("date").alias("inicio"), F.max("o_orderdate").cast("date").alias("fim")
    )
    return plain(dims.calendar(days, "inicio", "fim", months=preset.MONTHS, weekdays=preset.WEEKDAYS))


def calendar_kept(spark, folder):
    """A calendar that is there is not filled again, whatever the new range."""
    ends = {"inicio": F.min("o_orderdate").cast("date"), "fim": F.max("o_orderdate").cast("date")}
    days = table(spark, folder, "orders").agg(*[c.alias(n) for n, c in ends.items()])
    make = lambda last: dims.calendar(days, "inicio", last, months=preset.MONTHS, weekdays=preset.WEEKDAYS)
    first = scratch.stored(dims.calendar_if_empty(make("fim").where("false"), make("fim")), "calendario")
    return plain(dims.calendar_if_empty(first, make(F.date_add("fim", 400))))


def dim_members(spark, folder):
    """Countries after two loads: the second adds to the first."""
    clean = scratch.stored(silver(spark, folder, (DAYS[0], LATEST), ["pais", DAY]).distinct(), "paises")
    first = preset.country_dim(of_day(clean, DAYS[0]))
    return dims.grow(first, preset.country_dim(of_day(clean)), "sk_pais").select("pais")


def dim_marital(spark, folder):
    return preset.marital_dim(silver(spark, folder, columns=["estado_civil"])).select("estado_civil")


def dim_ordered(spark, folder):
    clean = silver(spark, folder, columns=["escolaridade"])
    return preset.education_dim(clean).select("escolaridade", "nivel_ordem")


def dim_static(spark, folder):
    """A fixed domain written over the members that part types have left in the table."""
    parts = table(spark, folder, "part").groupBy(F.col("p_type").alias("cod_categoria")).agg(
        F.lower(F.min("p_type")).alias("categoria")
    )
    old = parts.unionByName(
        table(spark, folder, "part").select(F.lit("MOVEIS").alias("cod_categoria"), F.lit("antigo").alias("categoria")).distinct()
    ).select(keys.hash_key(F.col("cod_categoria")).alias("sk_categoria"), "cod_categoria", "categoria")
    return merge.upsert(old, preset.category_dim(spark), ["sk_categoria"]).select("cod_categoria", "categoria")


def bands(spark, folder):
    clean = silver(spark, folder, columns=["id_cliente", "ano_nascimento", "salario_anual", DAY])
    age = F.year(DAY) - F.col("ano_nascimento")
    return clean.select(
        "id_cliente",
        preset.income_band().alias("faixa_salarial"),
        age.alias("idade"),
        preset.age_band(age).alias("faixa_etaria"),
    )


def surrogate_keys(spark, folder):
    """What keys have to be like: as many as values, each of one value; date keys also by their bounds."""
    clean = scratch.stored(silver(spark, folder, DAYS, ["id_cliente", "pais", "escolaridade", "data_cadastro", DAY]), "chaves")
    natural = {
        "pais": (F.col("pais"), keys.hash_key(F.col("pais"))),
        "escolaridade": (F.col("escolaridade"), keys.hash_key(F.col("escolaridade"))),
        "versao": (F.concat_ws("/", "id_cliente", DAY), keys.version_key(F.col("id_cliente"), F.col(DAY))),
        "data_cadastro": (F.col("data_cadastro").cast("string"), keys.date_key(F.col("data_cadastro"))),
    }
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("dimensao"), value.alias("valor"), key.cast("bigint").alias("chave")) for n, (value, key) in natural.items()
    ]))
    pairs = clean.select(rows.alias("r")).select("r.*").distinct()
    by_value = pairs.groupBy("dimensao", "valor").agg(F.count("*").alias("n"), F.min("chave").alias("chave"))
    by_key = pairs.groupBy("dimensao", "chave").agg(F.count("*").alias("n"))
    dated = F.col("dimensao") == "data_cadastro"
    return by_value.groupBy("dimensao").agg(
        F.count("*").alias("valores"), F.max("n").alias("chaves_por_valor"),
        F.min(F.when(dated, F.col("chave"))).alias("menor"), F.max(F.when(dated, F.col("chave"))).alias("maior"),
    ).join(by_key.groupBy("dimensao").agg(F.count("*").alias("chaves"), F.max("n").alias("valores_por_chave")), "dimensao")


# ---------------------------------------------------------------------------- versions
def scd2_history(spark, folder):
    return plain(versions(silver(spark, folder, DAYS)), *VERSION_COLUMNS)


def _loaded(source: DataFrame, days: Sequence[date]) -> DataFrame:
    """The dimension load by load: each load reads and writes current versions, and adds those it closes."""
    spark, table = source.sparkSession, scratch.new_path(source.sparkSession, "dim_cliente")
    moved = scd2.from_history(of_day(source, days[0]), VERSIONS, day=DAY)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in moved.schema.fields])
    for number, day in enumerate(days):
        if number:
            current = generations.read_versions(spark, table, schema, scd2.CURRENT, number).where(scd2.CURRENT)
            moved = scd2.apply_snapshot(current, of_day(source, day).drop(DAY), F.lit(day), VERSIONS)
        generations.write_versions(moved, table, after=number, current=scd2.CURRENT, end=scd2.TO)
    return generations.read_versions(spark, table, schema, scd2.CURRENT, len(days))


def scd2_iterated(spark, folder):
    source = scratch.stored(preset.version_source(silver(spark, folder, DAYS)), "origem")
    return plain(_loaded(source, DAYS), *VERSION_COLUMNS)


def _corrected(clean: DataFrame) -> DataFrame:
    """The last load sent again: some rows missing, some with another marital status."""
    key = F.col("id_cliente")
    again = of_day(clean).where(key % 7 != 0)
    return again.withColumn("estado_civil", F.when(key % 5 == 0, "Divorciado").otherwise(F.col("estado_civil")))


def scd2_same_day_fix(spark, folder):
    clean = history(spark, folder)
    dim = _loaded(preset.version_source(clean), DAYS)
    again = preset.version_source(_corrected(clean)).drop(DAY)
    return plain(scd2.apply_snapshot(dim, again, F.lit(LATEST), VERSIONS), *VERSION_COLUMNS)


def scd2_as_of(spark, folder):
    """Versions valid on a day, out of a stored table whose closed versions lie in folders by their last year."""
    dim, target = versions(silver(spark, folder, DAYS)), scratch.new_path(spark, "dim_cliente")
    number = generations.write_versions(dim, target, after=0, current=scd2.CURRENT, end=scd2.TO)
    stored = generations.read_versions(spark, target, dim.schema, scd2.CURRENT, number, since=DAYS[1])
    return plain(scd2.as_of(stored, F.lit(DAYS[1])), *VERSION_COLUMNS)


# ---------------------------------------------------------------------------- facts
def fact_snapshot(spark, folder):
    fact = preset.snapshot_fact(versioned(history(spark, folder)))
    return plain(fact.drop("sk_cliente", "sk_pais", "sk_escolaridade", "sk_estado_civil", DAY))


def fact_category(spark, folder):
    clean = history(spark, folder)
    named = preset.category_fact(versioned(clean), ["id_cliente"]).join(preset.category_dim(spark), "sk_categoria")
    return plain(named, "id_cliente", "sk_data_carga", "categoria", "valor_gasto")


def fact_channel(spark, folder):
    clean = history(spark, folder)
    named = preset.channel_fact(versioned(clean), ["id_cliente"]).join(preset.channel_dim(spark), "sk_canal")
    return plain(named, "id_cliente", "sk_data_carga", "canal", "qtd_compras")


def fact_campaign(spark, folder):
    clean = history(spark, folder)
    named = preset.campaign_fact(versioned(clean), ["id_cliente"]).join(preset.campaign_dim(spark), "sk_campanha")
    return plain(named, "id_cliente", "sk_data_carga", "campanha", "aceitou")


# ---------------------------------------------------------------------------- business report
KPIS = ["clientes", "gasto", "ticket", "conversao", "campanhas", "salario", "idade"]


def kpi_delta(spark, folder):
    """Every load's figures with the change against the load before; each row joins its own day's version."""
    clean = history(spark, folder)
    fact = preset.snapshot_fact(preset.with_version(clean, versions(clean)))
    return rounded(report.period_delta(report.kpi(fact), KPIS, period="sk_data_carga"), "valor", "anterior", "variacao_pct")


def kpi_newest_two(spark, folder):
    """The newest successful load against the successful one before; the load between them has failed.

    The fact is a table of slices: what the two loads are is found at run time, and the other slices are not read.
    """
    clean = history(spark, folder)
    fact, target = preset.snapshot_fact(preset.with_version(clean, versions(clean))), scratch.new_path(spark, "fato_cliente_snapshot")
    slices.write_slices(fact, target)
    status = F.when(F.col(DAY) == F.lit(DAYS[1]), "ERRO_SILVER").otherwise("SUCESSO")
    state = clean.groupBy(F.col(DAY)).agg(F.count("*").alias("linhas")).select(F.col(DAY).alias("data_carga"), status.alias("status"))
    newest = report.newest_two(scratch.stored(state, "estado")).select(F.col("data_carga").alias(DAY))
    both = report.kpi(slices.read_table(spark, target, fact.schema).join(newest, DAY, "left_semi"))
    return rounded(report.period_delta(both, KPIS, period="sk_data_carga"), "valor", "anterior", "variacao_pct")


def category_share(spark, folder):
    fact = preset.category_fact(versioned(history(spark, folder)))
    totals = report.sum_by(fact, "valor_gasto", "categoria", dim=preset.category_dim(spark), key="sk_categoria")
    return rounded(plain(report.positioned(report.share_of_total(totals, "valor"), F.col("valor").desc(), "rotulo")), "fracao")


def channel_share(spark, folder):
    fact = preset.channel_fact(versioned(history(spark, folder)))
    totals = report.sum_by(fact, "qtd_compras", "canal", dim=preset.channel_dim(spark), key="sk_canal")
    return rounded(plain(report.positioned(report.share_of_total(totals, "valor"), F.col("valor").desc(), "rotulo")), "fracao")


def campaign_rate(spark, folder):
    fact = preset.campaign_fact(versioned(history(spark, folder)))
    rates = report.rate_by(fact, "aceitou", "campanha", dim=preset.campaign_dim(spark), key="sk_campanha")
    return rounded(rates, "valor").orderBy("rotulo")


def country_spend(spark, folder):
    clean = history(spark, folder)
    fact = preset.snapshot_fact(versioned(clean))
    spend = report.count_by(fact, "total_gasto", "pais", dim=preset.country_dim(clean), key="sk_pais")
    return plain(report.positioned(spend, F.col("gasto").desc(), "rotulo"))


def mean_with_gaps(spark, folder):
    """Salaries by country: rows without one count, but take no part in the mean."""
    clean = history(spark, folder)
    fact = preset.snapshot_fact(versioned(clean))
    means = report.mean_by(fact, "salario_anual", "pais", dim=preset.country_dim(clean), key="sk_pais")
    return rounded(report.positioned(means, F.col("valor").desc_nulls_last(), "rotulo"), "valor")


def income_band(spark, folder):
    clean = history(spark, folder)
    dim = scratch.stored(versions(clean), "dim_cliente")
    fact = preset.snapshot_fact(preset.with_version(of_day(clean), scd2.as_of(dim, F.lit(LATEST))))
    out = report.by_version_attr(fact, dim, "faixa_salarial", "total_gasto", key="sk_cliente")
    order = [*preset.INCOME_BANDS, preset.NOT_GIVEN]
    return rounded(report.positioned(out, derive.position(F.col(report.LABEL), {x: i for i, x in enumerate(order)}, unknown=len(order)), report.LABEL), "valor")


def age_band(spark, folder):
    fact = preset.snapshot_fact(versioned(history(spark, folder)))
    order = [*[label for _, label in preset.AGE_BANDS], preset.AGE_ABOVE, preset.NOT_GIVEN]
    place = derive.position(F.col(report.LABEL), {x: i for i, x in enumerate(order)}, unknown=len(order))
    return rounded(report.positioned(report.mean_by(fact, "total_gasto", "faixa_etaria"), place, report.LABEL), "valor")


def education_level(spark, folder):
    clean = history(spark, folder)
    fact = preset.snapshot_fact(versioned(clean))
    levels = report.mean_by(
        fact, "total_gasto", "escolaridade", "nivel_ordem", dim=preset.education_dim(clean), key="sk_escolaridade"
    )
    return rounded(report.positioned(levels, "nivel_ordem", "rotulo"), "valor")


def scd_stats(spark, folder):
    return report.scd_stats(versions(silver(spark, folder, DAYS)), "id_cliente")


# ---------------------------------------------------------------------------- operation report
def loads_latest(spark, folder):
    return plain(report.positioned(report.loads(binding.load_state(spark, folder)), F.col("data_carga").desc()))


def load_totals(spark, folder):
    return rounded(report.load_totals(binding.load_state(spark, folder)), "pct_quarentena")


def recent_runs(spark, folder):
    log = binding.execution_log(spark, folder)
    latest = report.top_recent(log, "inicio_ts", 40, tie="execucao_id")
    return plain(report.positioned(latest, F.col("inicio_ts").desc(), F.col("execucao_id").desc()).drop("inicio_ts"))


#: The way a visit goes; what is not on it comes last.
STAGE_ORDER = ["view", "click", "signup", "purchase"]


def stage_duration(spark, folder):
    log = binding.execution_log(spark, folder)
    seconds = report.stage_duration(
        log, run="run_id", time="inicio_ts", tie="execucao_id", stage="etapa", seconds="duracao_seg"
    )
    return plain(report.positioned(seconds, derive.order_by_domain(F.col("etapa"), STAGE_ORDER), "etapa"))


def run_succeeded(spark, folder):
    log = binding.execution_log(spark, folder)
    return plain(report.run_succeeded(log, run="run_id", time="inicio_ts", tie="execucao_id"))


def recent_errors(spark, folder):
    return plain(report.top_recent(binding.error_log(spark, folder), "erro_ts", 15, tie="erro_id").drop("erro_ts"))


def error_summary(spark, folder):
    return report.error_summary(binding.error_log(spark, folder))


def dq_latest(spark, folder):
    """Every load was evaluated by two runs, a day apart; the later run of the latest load remains."""
    runs = F.explode(F.sequence(F.lit(1), F.lit(2)))
    results = _rule_results(spark, folder).withColumn("_vez", runs).withColumns(
        {
            "run_id": F.concat(F.lit("run-"), keys.date_key(F.col(DAY)).cast("string"), F.lit("-"), F.col("_vez").cast("string")),
            "avaliado_ts": F.date_add(DAY, F.col("_vez")),
            "falhas": F.when(F.col("_vez") == 2, F.col("falhas")).otherwise(F.col("falhas") + 1),
        }
    )
    latest = report.dq_latest(scratch.stored(results, "resultados"))
    return rounded(plain(report.positioned(latest, "severidade", "regra").drop("descricao", "avaliado_ts", "_vez", DAY)), "pct_falha")


def dq_runs(spark, folder):
    """Rule results of two runs kept side by side for every load; what a run writes again replaces its own rows only."""
    results, target = scratch.stored(_rule_results(spark, folder).drop("descricao"), "resultados"), scratch.new_path(spark, "dq_resultado")
    for run in ("run-1", "run-1", "run-2"):
        for day in DAYS:
            slices.append_part(of_day(results, day).withColumn("run_id", F.lit(run)), target, day, run)
    kept = slices.read_parts(spark, target, T.StructType([*results.schema.fields, T.StructField("run_id", T.StringType())]))
    return rounded(plain(kept), "pct_falha")


def dq_totals(spark, folder):
    results = _rule_results(spark, folder)
    return report.dq_totals(of_day(results))


#: Layers in the order data passes them, and where the given tables would lie.
LAYER_ORDER = ["landing", "bronze", "silver", "gold"]
STORAGE = {n: "landing" if n in ("documents", "pages", "benchmark") else "bronze" for n in binding.TABLES} | dict.fromkeys(
    ["customer", "supplier", "part", "nation", "region"], "gold"
) | dict.fromkeys(["orders", "lineitem"], "silver")


def inventory(spark, folder):
    counted = report.inventory({n: (STORAGE[n], table(spark, folder, n)) for n in binding.TABLES})
    return report.positioned(counted, derive.order_by_domain(F.col("camada"), LAYER_ORDER), "tabela")


# Descriptions of a few columns, so that the dictionary has documented and undocumented ones.
DESCRIBED = {
    ("customer", "c_custkey"): "Chave do cliente",
    ("customer", "c_acctbal"): "Saldo",
    ("orders", "o_orderkey"): "Chave do pedido",
    ("orders", "o_orderdate"): "Data do pedido",
    ("lineitem", "l_extendedprice"): "Valor da linha",
    ("events", "ts"): "Momento do evento",
}
SENSITIVE = ["c_custkey", "c_name", "c_acctbal", "user_id"]
LAYERS = {n: "texto" if n in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings") else "estrela" for n in binding.TABLES}


def _dictionary(spark, folder) -> DataFrame:
    found = catalog.footer_profile(spark, {n: (f"{folder}/{n}.parquet", schema) for n, schema in binding.SCHEMAS.items()})
    return catalog.described(found, layers=LAYERS, descriptions=DESCRIBED, confidential=SENSITIVE)


def profile(spark, folder):
    return _dictionary(spark, folder)


def dictionary_coverage(spark, folder):
    dictionary = _dictionary(spark, folder)
    filled = dictionary.groupBy("camada").agg(F.sum("preenchidas").alias("valores"))
    return rounded(report.dictionary_coverage(dictionary).join(filled, "camada"), "fracao_documentada")


# ---------------------------------------------------------------------------- checks
def _layers(spark, folder) -> tuple[dict[str, measured.Figures], DataFrame, DataFrame, dict[str, DataFrame]]:
    """The layers as stored tables, each made from the one before, with the figures of the latest load from the writes.

    Accepted rows pass from evaluation to their table in one job, which counts the rejected ones on the way.
    """
    latest = F.col(DAY) == F.lit(LATEST)
    raw, received = measured.stored(binding.customer_snapshots(spark, folder, DAYS), "bronze", ultima=F.count_if(latest))
    repeated = scratch.stored(preset.repeated_ids(raw), "repetidos")
    evaluated, seen = measured.observed(
        preset.evaluate(raw, stage=None, keys=repeated).evaluated, retidas=F.count_if(F.col(quality.BLOCKED) & latest)
    )
    clean, accepted = measured.stored(preset.accepted(quality.split(evaluated)).select(*MEASURES), "silver", ultima=F.count_if(latest))
    dim = scratch.stored(versions(clean), "dim_cliente")
    base = scratch.stored(preset.with_version(of_day(clean), scd2.as_of(dim, F.lit(LATEST))), "base_fatos")
    figures = {"bronze": received, "quarentena": seen.get, "silver": accepted}
    tables = {}
    for name, fact in preset.build_facts(base).items():
        tables[name], figures[name] = measured.stored(fact, name, **fact_measures(name))
    return figures, clean, dim, tables


def _dims(spark, clean: DataFrame, dim: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    return {
        "sk_cliente": (dim, "sk_cliente"),
        "sk_pais": (preset.country_dim(clean), "sk_pais"),
        "sk_escolaridade": (preset.education_dim(clean), "sk_escolaridade"),
        "sk_estado_civil": (preset.marital_dim(clean), "sk_estado_civil"),
    }


def _calendar_until_2029(spark, folder) -> DataFrame:
    """A calendar from the first order on: the sign-up dates in 2030 have no day in it."""
    bounds = table(spark, folder, "orders").agg(F.min("o_orderdate").cast("date").alias("inicio"))
    return dims.calendar(bounds, "inicio", F.lit(date(2029, 12, 31)), months=preset.MONTHS, weekdays=preset.WEEKDAYS)


def checks_all(spark, folder):
    """The reconciliation suite over the latest load, and on all versions.

    Counts and sums are those of the writes; the snapshot and the versions are read once each for all that is asked of them.
    """
    figures, clean, dim, facts = _layers(spark, folder)
    days = _calendar_until_2029(spark, folder)
    roles = {"sk_data_carga": (days, "sk_data"), "sk_data_cadastro": (days, "sk_data")}
    snapshot = facts["fato_cliente_snapshot"]
    figures["orfas"] = checks.orphan_rows(snapshot, {"membros": _dims(spark, of_day(clean), dim), "datas": roles}).first().asDict()
    figures["versoes"] = checks.version_figures(dim, "id_cliente", "sk_cliente").first().asDict()
    base = "fato_cliente_snapshot_linhas"
    counted = checks.compared(
        measured.row(spark, **figures),
        [
            checks.some("V02 a carga trouxe linhas", "bronze_ultima"),
            checks.adds_up("V03 toda linha aceita ou retida", "bronze_ultima", "silver_ultima", "quarentena_retidas"),
            checks.adds_up("V04 um fato por cliente aceito", "silver_ultima", base),
            *[checks.adds_up(f"V0{5 + i} {n} linhas por cliente", f"{name}_linhas", base, times=n) for i, (name, n) in enumerate(FACT_ROWS.items())],
            checks.same_amount("V08 mesmo gasto nos dois fatos", "fato_cliente_snapshot_total", "fato_gasto_categoria_total"),
            checks.none("V09 uma versao aberta", "versoes_atuais"),
            checks.none("V10 intervalos em ordem", "versoes_invalidas"),
            checks.none("V11 todo fato acha os membros", "orfas_membros"),
            checks.none("V12 todo fato acha as datas", "orfas_datas"),
            checks.none("V14 versoes sem intervalo entre si", "versoes_quebras"),
            checks.none("V15 chave de versao sem repeticao", "versoes_repetidas"),
        ],
    )
    state = binding.load_state(spark, folder)
    ends = state.agg(F.min("data_carga").alias("primeira"), F.max("data_carga").alias("ultima"))
    run = table(spark, folder, "events").agg(F.max("user_id").alias("run_id_ultimo"))
    log = binding.execution_log(spark, folder)
    first, last = (state.join(ends, F.col("data_carga") == F.col(end)) for end in ("primeira", "ultima"))
    return plain(
        checks.run_all(
            [
                checks.load_state("V01 primeira carga com sucesso", first, "SUCESSO"),
                checks.load_state("V01 ultima carga com sucesso", last, "SUCESSO"),
                counted,
                checks.no_failed_stage("V13 sem etapa com erro", log, run),
            ]
        )
    )


def orphan_keys(spark, folder):
    """Snapshot rows without a member: a country dimension of four regions, and a calendar up to 2029."""
    clean = history(spark, folder)
    four = table(spark, folder, "nation").where("n_regionkey < 4").select(F.col("n_name").alias("pais"))
    days = _calendar_until_2029(spark, folder)
    return checks.orphan_keys(
        preset.snapshot_fact(versioned(clean)),
        {
            "sk_pais": (preset.country_dim(four), "sk_pais"),
            "sk_escolaridade": (preset.education_dim(clean), "sk_escolaridade"),
            "sk_data_carga": (days, "sk_data"),
            "sk_data_cadastro": (days, "sk_data"),
        },
    )


# ---------------------------------------------------------------------------- table changes
def _customer_totals(spark, folder) -> DataFrame:
    """Orders per customer; those from 2001 on go to keys of their own, which no table has yet."""
    key = F.when(F.year("o_orderdate") >= 2001, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey"))
    return table(spark, folder, "orders").groupBy(key.alias("id")).agg(
        F.count(F.lit(1)).alias("pedidos"), F.max(F.col("o_orderdate").cast("date")).cast("string").alias("ultimo")
    )


def _customer_table(spark, folder) -> DataFrame:
    """All customers, before any order was counted."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.lit(0).cast("bigint").alias("pedidos"),
        F.lit(None).cast("string").alias("ultimo"),
    )


def merge_insert_new(spark, folder):
    return merge.insert_new(_customer_table(spark, folder), _customer_totals(spark, folder), ["id"])


def merge_upsert(spark, folder):
    return merge.upsert(_customer_table(spark, folder), _customer_totals(spark, folder), ["id"])


def merge_upsert_keep(spark, folder):
    """Upsert of the load state by deliveries, every second one of a later day: counts and the first sight of a load survive."""
    target = binding.load_state(spark, folder).select(
        "data_carga", "impressao", "status", "linhas_silver", F.lit("antes").alias("criado_em")
    )
    later = F.when(F.col("_menor") % 2 == 0, F.col("data_carga")).otherwise(F.date_add("data_carga", 10_000))
    source = binding.deliveries(spark, folder).select(
        later.alias("data_carga"), "impressao", F.lit("PENDENTE").alias("status"), F.lit("agora").alias("criado_em")
    )
    return plain(merge.upsert(target, source, ["data_carga"], keep=["criado_em"]))


def merge_update_columns(spark, folder):
    """Counts of one order are missing in the changes, and leave the column as it is."""
    several = F.when(F.col("pedidos") > 1, F.col("pedidos"))
    changes = _customer_totals(spark, folder).withColumn("pedidos", several)
    return merge.update_columns(_customer_table(spark, folder), changes, ["id"], allowed=["pedidos", "ultimo"])


def generation_replace(spark, folder):
    """A table rewritten as a whole twice, the second time from itself."""
    target = scratch.new_path(spark, "clientes")
    first = table(spark, folder, "customer").select("c_custkey", "c_nationkey", F.lit(1).alias("vez"))
    number = generations.write_next(first, target, after=generations.latest(spark, target))
    again = generations.read_latest(spark, target, first.schema).withColumn("vez", F.col("vez") + 1)
    generations.write_next(again, target, after=number)
    return generations.read_latest(spark, target, first.schema)


def slice_replace(spark, folder):
    """Slices of orders by year, all written by one job; then one job replaces the second by some of its own rows and the third by none."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("ano"))
    target = scratch.new_path(spark, "fatias")
    slices.write_slices(orders.withColumn(DAY, F.make_date("ano", F.lit(1), F.lit(1))), target)
    first = slices.days(spark, target)[:3]
    own = slices.read_slices(spark, target, first[1:2], orders.schema)
    slices.write_slices(own.where(F.col("o_orderstatus") == "F"), target, emptied=first[1:])
    return plain(slices.read_table(spark, target, orders.schema))


# ---------------------------------------------------------------------------- loads
def load_manifest(spark, folder):
    """Names of deliveries, some of them wrong, read back to dates."""
    key = F.col("_menor")
    stamp = F.date_format("data_carga", "yyyyMMdd")
    name = (
        F.when(key % 11 == 1, F.concat(F.lit("vendas_"), stamp, F.lit(".csv")))
        .when(key % 11 == 2, F.concat(F.lit("marketing_"), F.date_format("data_carga", "yyyy-MM-dd"), F.lit(".csv")))
        .when(key % 11 == 3, F.concat(F.lit("marketing_"), F.date_format("data_carga", "yyyy"), F.lit("1340.csv")))
        .when(key % 11 == 4, F.concat(F.lit("MARKETING_"), stamp, F.lit(".CSV")))
        .when(key % 11 == 5, F.concat(F.lit("marketing_"), stamp, F.lit(".csv.bak")))
        .when(key % 11 == 6, F.concat(F.lit("marketing_"), stamp, F.lit(".txt")))
        .otherwise(F.col("arquivo"))
    )
    files = binding.deliveries(spark, folder).select(name.alias("arquivo"), key.alias("tamanho_bytes"))
    found = loads.manifest(files, prefix="marketing", extension="csv")
    expected = loads.expected_name(F.col(loads.DAY), "marketing", "csv")
    return plain(found.withColumn("nome_esperado", expected))


def load_fingerprint(spark, folder):
    """One fingerprint per load over all its rows."""
    raw = binding.customer_snapshots(spark, folder, DAYS)
    return plain(loads.fingerprint(raw, preset.COLUMNS, by=[DAY]))


def _plan(spark, folder, request: loads.Request) -> DataFrame:
    candidates = binding.deliveries(spark, folder).select("data_carga", "arquivo", "impressao")
    return plain(loads.plan(candidates, binding.load_state(spark, folder, some=True), request))


def load_plan(spark, folder):
    return _plan(spark, folder, loads.Request())


def load_register(spark, folder):
    """The load state with the planned and the refused loads written in."""
    state = binding.load_state(spark, folder, some=True).withColumns({"criado_em": F.lit("antes"), "atualizado_em": F.lit("antes")})
    candidates = binding.deliveries(spark, folder).select("data_carga", "arquivo", "impressao")
    planned = loads.plan(candidates, state, loads.Request())
    return plain(loads.register(state, planned, "run-9", F.lit("agora")))


def load_discovery(spark, folder):
    """Files of orders, one a month, found in the folder they were delivered to, with dates, sizes and fingerprints.

    The writer names its files by itself, so the finished ones are given the names of deliveries; one month is asked for
    no more, and one file is named wrongly.
    """
    landing, made = scratch.new_path(spark, "entregas"), scratch.new_path(spark, "meses")
    line = F.concat_ws(";", F.col("o_orderkey").cast("string"), F.col("o_orderstatus"))
    orders = table(spark, folder, "orders").select(line.alias("value"), F.date_format("o_orderdate", "yyyyMM").alias("mes"))
    orders.repartition("mes").write.partitionBy("mes").text(made)
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(made).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place(landing))
    for found in files.globStatus(place(f"{made}/mes=*/part-*")):
        month = found.getPath().getParent().getName().removeprefix("mes=")
        name = f"vendas_{month}01.csv" if month.endswith("02") else f"{'MARKETING' if month.endswith('03') else 'marketing'}_{month}01.csv"
        files.rename(found.getPath(), place(f"{landing}/{name}"))
    done = table(spark, folder, "orders").agg(F.trunc(F.min("o_orderdate"), "month").alias("data_carga"))
    return plain(Warehouse(spark, landing).candidates(landing, done).drop("caminho"))


def load_plan_redo(spark, folder):
    return _plan(spark, folder, loads.Request(day=date(1999, 3, 15), reprocess=True))


def load_plan_copies(spark, folder):
    """Every registered load that a planned one repeats."""
    candidates = binding.deliveries(spark, folder).select("data_carga", "arquivo", "impressao")
    state = binding.load_state(spark, folder, some=True)
    return plain(loads.copies_of(loads.plan(candidates, state, loads.Request()), state))


def load_copies(spark, folder):
    return plain(loads.copies(binding.load_state(spark, folder)))


def load_advance(spark, folder):
    """Outcomes of the quality stage for every delivery; only loads that wait for it move."""
    outcomes = binding.deliveries(spark, folder).select(
        "data_carga",
        F.lit("silver").alias("etapa"),
        (F.col("_menor") % 4 != 0).alias("ok"),
        F.concat(F.lit("falha em "), F.col("arquivo")).alias("mensagem"),
        F.lit(None).cast("bigint").alias("linhas_bronze"),
        F.col("linhas").alias("linhas_silver"),
        F.lit(0).cast("bigint").alias("linhas_quarentena"),
    )
    return plain(loads.advance(binding.load_state(spark, folder), outcomes).drop("impressao", "tamanho_bytes", "atualizado_em"))


def last_success(spark, folder):
    return plain(loads.last_success(binding.load_state(spark, folder)))


def loads_in_state(spark, folder):
    waiting = loads.in_state(binding.load_state(spark, folder), "run-1", "SUCESSO").select("data_carga", "arquivo", "tentativas")
    return plain(report.positioned(waiting, "data_carga"))


def stage_active(spark, folder):
    """Executions per stage with the stage's switch; stages that failed most are off, one is not listed."""
    log = binding.execution_log(spark, folder)
    per_stage = log.groupBy("etapa").agg(F.count(F.lit(1)).alias("execucoes"))
    switches = log.where(F.col("etapa") != "view").groupBy("etapa").agg(
        (F.count_if(F.col("status") == "ERRO") == 0).alias("ativo")
    )
    return plain(loads.stage_active(switches, per_stage))


def resolve_params(spark, folder):
    """A limit per part, replaced by the supplied one where its row is active."""
    defaults = table(spark, folder, "part").select(
        F.concat(F.lit("limite_"), F.col("p_partkey").cast("string")).alias("parametro"),
        F.col("p_size").cast("string").alias("valor"),
    )
    overrides = table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.max("l_quantity").cast("int").alias("q"), F.count(F.lit(1)).alias("n")
    ).select(
        F.concat(F.lit("limite_"), F.col("l_partkey").cast("string")).alias("parametro"),
        F.col("q").cast("string").alias("valor"),
        (F.col("n") % 2 == 0).alias("ativo"),
    )
    return params.resolve_params(defaults, overrides)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        customer_snapshot, contract_projection, audit_columns, delimited_file, load_not_empty, row_numbers, row_hash, typed_customers,
        quality_accepted, quality_quarantine, quality_summary, quality_gate, content_clones,
        first_occurrence, occurrence_number,
        calendar, calendar_kept, dim_members, dim_marital, dim_ordered, dim_static, bands, surrogate_keys,
        scd2_history, scd2_iterated, scd2_same_day_fix, scd2_as_of,
        fact_snapshot, fact_category, fact_channel, fact_campaign,
        kpi_delta, kpi_newest_two, category_share, channel_share, campaign_rate, country_spend, mean_with_gaps, income_band,
        age_band, education_level, scd_stats,
        loads_latest, load_totals, recent_runs, stage_duration, run_succeeded, recent_errors,
        error_summary, dq_latest, dq_runs, dq_totals, inventory, profile, dictionary_coverage,
        checks_all, orphan_keys,
        merge_insert_new, merge_upsert, merge_upsert_keep, merge_update_columns, generation_replace, slice_replace,
        load_manifest, load_fingerprint, load_plan, load_plan_redo, load_register, load_discovery, load_copies, load_advance,
        last_success, load_plan_copies, loads_in_state, stage_active, resolve_params,
    )
}
