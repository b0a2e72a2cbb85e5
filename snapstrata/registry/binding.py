"""The customer snapshots, load states and logs of the registered queries, out of the given tables.

Every customer, order, line and event takes part. A few customers, picked by the remainder of their
key, get a defect each, so that every rule has something to find; no row is left out for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.plans import customers as preset
from snapstrata.sources import ingest

# Column names and types of the given tables: read as a contract, so no job infers them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = list(SCHEMAS)

#: The last cut lies after every order.
DAYS = [date(1999, 12, 31), date(2000, 12, 31), date(2001, 12, 31)]
LATEST = DAYS[-1]

P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

#: What all customers with defect A004 look alike in; any valid row would do.
TWIN_ROW = (
    {c: str(3 + i) for i, c in enumerate([*preset.SPEND, *preset.COUNTS])}
    | {c: str(i % 2) for i, c in enumerate([*preset.CAMPAIGN_FLAGS, "comprou"])}
    | {"ano_nascimento": "1961", "escolaridade": list(preset.EDUCATION_ORDER)[-1], "estado_civil": preset.MARITAL_STATUS[-1]}
    | {"salario_anual": "27350", "data_cadastro": "14/2/1997", "pais": "CANADA"}
)


#: Columns that defect A007 makes unreadable: a sum, a count and a flag.
UNREADABLE = ["gasto_vestuario", "qtd_compras_web", "visitas_website_mes", "campanha_2_aceita"]


@dataclass(frozen=True)
class Defects:
    """Rule code to (divisor, remainder) of the customer keys that break it."""

    where: Mapping[str, tuple[int, int]] = field(
        default_factory=lambda: {
            "R001": (53, 50),
            "R002": (59, 55),
            "R003": (61, 58),
            "R004": (67, 60),
            "A001": (37, 1),
            "A002": (37, 4),
            "A003": (37, 9),
            "A004": (71, 20),
            "A005": (37, 14),
            "A006": (37, 19),
            "A007": (37, 24),
        }
    )

    def dirtier(self) -> Defects:
        """About a fifth of the rows blocked, so that the load fails its gate."""
        return Defects({**self.where, "R001": (17, 5), "R002": (19, 5), "R003": (20, 5), "R004": (22, 5)})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _until(column: str, day: date) -> Column:
    """On or before a day, on the stored type, so that the bound reaches the scan."""
    return F.col(column) < F.expr(f"timestamp_ntz'{day + timedelta(days=1)}'")


def _period(column: str, days: Sequence[date]) -> Column:
    """Index of the first cut a row counts for."""
    out = F.when(_until(column, days[0]), 0)
    for i, day in enumerate(days[1:], start=1):
        out = out.when(_until(column, day), i)
    return out


def _by_cut(df: DataFrame, measures: Mapping[str, tuple[str, Column]], cuts: int) -> DataFrame:
    """Aggregates per customer and cut, each cut covering everything up to it.

    Rows are aggregated once per customer and period; only those few rows are then counted for
    every later cut, instead of reading the table once per cut.
    """
    merge = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    first = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    periods = df.groupBy("_cliente", "_corte").agg(
        *[first[how](value).alias(name) for name, (how, value) in measures.items()]
    )
    if cuts == 1:
        return periods
    later = F.explode(F.sequence(F.col("_corte"), F.lit(cuts - 1)))
    return (
        periods.withColumn("_corte", later)
        .groupBy("_cliente", "_corte")
        .agg(*[merge[how](name).alias(name) for name, (how, _) in measures.items()])
    )


def customer_snapshots(
    spark: SparkSession, folder: str, days: Sequence[date] = (LATEST,), defects: Defects = Defects()
) -> DataFrame:
    """Text rows of the snapshot contract, one load per day, with load date and row sequence."""
    days = sorted(days)
    orders = (
        table(spark, folder, "orders")
        .where(_until("o_orderdate", days[-1]))
        .withColumn("_corte", _period("o_orderdate", days))
        .withColumnRenamed("o_custkey", "_cliente")
    )
    lines = (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
        .join(orders.select("o_orderkey", "_cliente", "_corte"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    )
    # Whole cents add up exactly and fast; a decimal sum over every line would not be.
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    spend = _by_cut(
        lines,
        {
            **{c: ("sum", F.when(F.col("p_type") == t, cents)) for c, t in zip(preset.SPEND, P_TYPES)},
            "_desconto": ("count", F.when(F.col("l_discount") > 0, 1)),
        },
        len(days),
    )
    order_day = F.col("o_orderdate").cast("date")
    bought = _by_cut(
        orders,
        {
            "_pedidos": ("count", F.lit(1)),
            "_primeiro": ("min", order_day),
            "_ultimo": ("max", order_day),
            **{
                c: ("count", F.when(F.col("o_orderstatus") == s, 1))
                for c, s in zip(preset.CHANNEL_COUNTS, STATUSES)
            },
            **{
                c: ("max", F.when(F.col("o_orderpriority") == p, 1).otherwise(0))
                for c, p in zip(preset.CAMPAIGN_FLAGS, PRIORITIES)
            },
        },
        len(days),
    )
    visits = (
        table(spark, folder, "events")
        .where(F.col("event_type") == "view")
        .groupBy(F.col("user_id").alias("_cliente"))
        .agg(F.count(F.lit(1)).alias("_visitas"))
    )
    cut_days = F.array(
        *[F.struct(F.lit(i).alias("_corte"), F.lit(d).alias(ingest.LOAD_DAY)) for i, d in enumerate(days)]
    )
    people = (
        table(spark, folder, "customer")
        .withColumnRenamed("c_custkey", "_cliente")
        .join(visits, "_cliente", "left")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("_cliente", "c_acctbal", "c_mktsegment", "n_name", "_visitas", F.inline(cut_days))
    )
    facts = people.join(bought, ["_cliente", "_corte"], "left").join(spend, ["_cliente", "_corte"], "left")
    return _as_text(facts, defects)


def _as_text(facts: DataFrame, defects: Defects) -> DataFrame:
    key = F.col("_cliente")
    day = F.col(ingest.LOAD_DAY)

    hit = {rule: key % divisor == remainder for rule, (divisor, remainder) in defects.where.items()}

    def text(value: Column) -> Column:
        return value.cast("string")

    def count(column: str) -> Column:
        return text(F.coalesce(F.col(column), F.lit(0)))

    def money(column: str) -> Column:
        return text((F.coalesce(F.col(column), F.lit(0)).cast("decimal(18,0)") / 100).cast("decimal(18,2)"))

    salary = text(F.abs("c_acctbal").cast("decimal(12,2)"))
    levels = [x for s, e in zip(SEGMENTS, preset.EDUCATION_ORDER) for x in (F.lit(s), F.lit(e))]
    marital = F.array(*[F.lit(m) for m in preset.MARITAL_STATUS])
    orders = F.coalesce(F.col("_pedidos"), F.lit(0))
    recent = F.coalesce(F.date_diff(day, F.col("_ultimo")) < 365, F.lit(False))

    normal = {
        "ano_nascimento": text(1940 + key % 55),
        "escolaridade": F.try_element_at(F.create_map(*levels), F.col("c_mktsegment")),
        "estado_civil": F.element_at(marital, (orders % 3 + 1).cast("int")),
        "salario_anual": salary,
        "qtd_filhos": text(key % 4),
        "qtd_adolescentes": text(key % 3),
        "data_cadastro": F.date_format("_primeiro", "d/M/yyyy"),
        "dias_desde_ultima_compra": text(F.date_diff(day, F.col("_ultimo"))),
        **{c: money(c) for c in preset.SPEND},
        "qtd_compras_desconto": count("_desconto"),
        **{c: count(c) for c in preset.CHANNEL_COUNTS},
        "visitas_website_mes": count("_visitas"),
        **{c: count(c) for c in preset.CAMPAIGN_FLAGS},
        "comprou": text(recent.cast("int")),
        "pais": F.col("n_name"),
    }
    broken = {
        "ano_nascimento": [("A003", F.lit("1893"))],
        "escolaridade": [("A006", F.lit("Desconhecido"))],
        "salario_anual": [
            ("R004", F.concat(F.lit("-"), salary)),
            ("A001", F.lit("")),
            ("A002", F.lit("666666")),
        ],
        "data_cadastro": [("R003", F.lit("31/02/2022")), ("A005", F.lit("15/03/2030"))],
        **{c: [("A007", F.lit("abc"))] for c in UNREADABLE},
    }

    def content(column: str) -> Column:
        out = F.when(hit["A004"], F.lit(TWIN_ROW[column]))
        for rule, value in broken.get(column, []):
            out = out.when(hit[rule], value)
        return out.otherwise(normal[column]).alias(column)

    copies = F.when(hit["R002"], F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    identity = F.when(hit["R001"], F.concat(F.lit("X"), text(key))).otherwise(text(key))
    columns = [identity.alias(c) if c == "id_cliente" else content(c) for c in preset.COLUMNS]
    return facts.select(*columns, ingest.LOAD_DAY, key.alias("_k"), F.explode(copies).alias("_copia")).select(
        *preset.COLUMNS, ingest.LOAD_DAY, (F.col("_k") * 2 + F.col("_copia")).alias(ingest.ROW_SEQ)
    )


# ---------------------------------------------------------------------------- logs and load states
def execution_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as stage executions: the user is the run, the type the stage, the value the seconds."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("execucao_id"),
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("etapa"),
        F.when(F.col("event_type") == "error", "ERRO").otherwise("SUCESSO").alias("status"),
        F.col("ts").alias("inicio_ts"),
        F.col("value").cast("decimal(12,2)").alias("duracao_seg"),
    )


def error_log(spark: SparkSession, folder: str) -> DataFrame:
    """Error and signup events as errors and warnings."""
    events = table(spark, folder, "events").where(F.col("event_type").isin("error", "signup"))
    return events.select(
        F.col("event_id").alias("erro_id"),
        F.col("user_id").alias("run_id"),
        F.when(F.col("event_type") == "error", "ERRO").otherwise("AVISO").alias("severidade"),
        F.col("ts").alias("erro_ts"),
        F.col("props").alias("mensagem"),
    )


LOAD_STATES = [
    "SUCESSO", "PENDENTE", "ERRO_BRONZE", "SUCESSO", "ERRO_FORA_DE_ORDEM", "ERRO_SILVER",
    "BRONZE_OK", "SUCESSO", "SILVER_OK", "DIMENSOES_OK",
]
STATE_UNTIL = date(2000, 6, 30)


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """One delivery per order date: name, rows, and a fingerprint that some dates share."""
    per_day = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("data_carga"))
        .agg(
            F.count(F.lit(1)).alias("linhas"),
            F.min("o_orderkey").alias("_menor"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_total"),
        )
    )
    return per_day.select(
        "data_carga",
        F.concat(F.lit("marketing_"), F.date_format("data_carga", "yyyyMMdd"), F.lit(".csv")).alias("arquivo"),
        "linhas",
        F.when(F.dayofmonth("data_carga") == 15, F.concat(F.lit("mes-"), F.month("data_carga").cast("string")))
        .otherwise(F.concat_ws("-", F.col("linhas").cast("string"), F.col("_menor").cast("string"), F.col("_total").cast("string")))
        .alias("impressao"),
        "_menor",
    )


def load_state(spark: SparkSession, folder: str, *, some: bool = False) -> DataFrame:
    """A registered load per delivery, in states that follow from the data.

    ``some`` leaves deliveries unregistered, for planning to find: a third of the dates, and those after a day.
    """
    states = F.array(*[F.lit(s) for s in LOAD_STATES])
    index = F.col("_menor") % len(LOAD_STATES)
    known = (F.col("data_carga") <= F.lit(STATE_UNTIL)) & (F.col("_menor") % 3 != 0)
    return (
        deliveries(spark, folder)
        .where(known if some else F.lit(True))
        .select(
            "data_carga",
            "arquivo",
            F.element_at(states, (index + 1).cast("int")).alias("status"),
            (F.col("linhas") % 5 + 1).cast("int").alias("tentativas"),
            "impressao",
            (F.col("linhas") * 10).alias("linhas_bronze"),
            (F.col("linhas") * 10 - F.col("_menor") % 7).alias("linhas_silver"),
            (F.col("_menor") % 7).alias("linhas_quarentena"),
            F.concat(F.lit("run-"), (F.col("_menor") % 4).cast("string")).alias("run_id_ultimo"),
            (F.col("linhas") * 120 + F.col("_menor") % 97).alias("tamanho_bytes"),
            F.concat(F.date_format("data_carga", "yyyy-MM-dd"), F.format_string(" %02d:00:00", F.col("_menor") % 24)).alias("atualizado_em"),
        )
        .withColumn("mensagem", F.when(F.col("status").startswith("ERRO"), F.concat(F.lit("falha em "), F.col("arquivo"))))
    )
