"""Preset: the customer snapshot contract, its rules, and its star schema, out of the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.functions import coerce, derive, keys, rules
from snapstrata.functions.coerce import Field
from snapstrata.functions.rules import ALERT, BLOCKING, Rule
from snapstrata.operators import dims, facts, quality, scd2
from snapstrata.operators.params import Parameters
from snapstrata.sources import ingest
from snapstrata.sources.scratch import stored

# ------------------------------------------------------------------------------------------
# They have to equal those of the system whose results this preset matches.
# ------------------------------------------------------------------------------------------
CONTRACT = {
    "ID": "id_cliente",
    "Ano Nascimento": "ano_nascimento",
    "Escolaridade": "escolaridade",
    "Estado Civil": "estado_civil",
    "Salario Anual": "salario_anual",
    "Filhos em Casa": "qtd_filhos",
    "Adolescentes em Casa": "qtd_adolescentes",
    "Data Cadastro": "data_cadastro",
    "Dias Desde Ultima Compra": "dias_desde_ultima_compra",
    "Gasto com Eletronicos": "gasto_eletronicos",
    "Gasto com Brinquedos": "gasto_brinquedos",
    "Gasto com Moveis": "gasto_moveis",
    "Gasto com Utilidades": "gasto_utilidades",
    "Gasto com Alimentos": "gasto_alimentos",
    "Gasto com Vestuario": "gasto_vestuario",
    "Numero de Compras com Desconto": "qtd_compras_desconto",
    "Numero de Compras na Web": "qtd_compras_web",
    "Numero de Compras via Catalogo": "qtd_compras_catalogo",
    "Numero de Compras na Loja": "qtd_compras_loja",
    "Numero Visitas WebSite Mes": "visitas_website_mes",
    "Compra na Campanha 1": "campanha_1_aceita",
    "Compra na Campanha 2": "campanha_2_aceita",
    "Compra na Campanha 3": "campanha_3_aceita",
    "Compra na Campanha 4": "campanha_4_aceita",
    "Compra na Campanha 5": "campanha_5_aceita",
    "Comprou": "comprou",
    "Pais": "pais",
}

CATEGORIES = {
    "ELETRONICOS": ("Eletrônicos", "gasto_eletronicos"),
    "BRINQUEDOS": ("Brinquedos", "gasto_brinquedos"),
    "MOVEIS": ("Móveis", "gasto_moveis"),
    "UTILIDADES": ("Utilidades", "gasto_utilidades"),
    "ALIMENTOS": ("Alimentos", "gasto_alimentos"),
    "VESTUARIO": ("Vestuário", "gasto_vestuario"),
}
CHANNELS = {
    "WEB": ("Web", "qtd_compras_web"),
    "CATALOGO": ("Catálogo", "qtd_compras_catalogo"),
    "LOJA": ("Loja", "qtd_compras_loja"),
}
CAMPAIGNS = {
    "CAMPANHA_1": ("Campanha 1", "campanha_1_aceita"),
    "CAMPANHA_2": ("Campanha 2", "campanha_2_aceita"),
    "CAMPANHA_3": ("Campanha 3", "campanha_3_aceita"),
    "CAMPANHA_4": ("Campanha 4", "campanha_4_aceita"),
    "CAMPANHA_5": ("Campanha 5", "campanha_5_aceita"),
}
EDUCATION_ORDER = {
    "Primeiro Grau": 1,
    "Segundo Grau": 2,
    "Curso Superior": 3,
    "Mestrado": 4,
    "Doutorado": 5,
}
MARITAL_STATUS = ["Solteiro", "Casado", "Divorciado"]
NOT_GIVEN = "Não Informado"

TRACKED = [
    "ano_nascimento",
    "escolaridade",
    "estado_civil",
    "pais",
    "salario_anual",
    "qtd_filhos",
    "qtd_adolescentes",
]
CARRIED = [
    "ano_nascimento",
    "escolaridade",
    "estado_civil",
    "pais",
    "salario_anual",
    "faixa_salarial",
    "qtd_filhos",
    "qtd_adolescentes",
    "data_cadastro",
]

INCOME_BANDS = ["Baixa", "Média", "Alta", "Muito Alta"]
AGE_BANDS = [(40, "Até 39"), (50, "40-49"), (60, "50-59"), (70, "60-69")]
AGE_ABOVE = "70+"

MONTHS = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAYS = ["Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado", "Domingo"]

DEFAULTS = {
    "arquivo_prefixo": "marketing",
    "arquivo_extensao": "csv",
    "csv_separador": ";",
    "csv_encoding": "UTF-8",
    "formato_data_origem": "d/M/yyyy",
    "ano_nascimento_min": "1900",
    "salario_max_outlier": "300000",
    "limite_rejeicao_pct": "10",
    "max_tentativas": "3",
    "faixa_salarial_baixa_ate": "30000",
    "faixa_salarial_media_ate": "60000",
    "faixa_salarial_alta_ate": "100000",
    "dim_data_inicio": "2010-01-01",
    "dim_data_fim": "2035-12-31",
}

#: Code of a rule, its severity, what becomes of the row or field, and the text of its result.
RULES = {
    "R001_ID_INVALIDO": ("BLOQUEANTE", "QUARENTENA", "id_cliente nulo ou nao numerico"),
    "R002_ID_DUPLICADO": ("BLOQUEANTE", "QUARENTENA", "id_cliente repetido na mesma carga (mantem a 1a ocorrencia)"),
    "R003_DATA_CADASTRO_INVALIDA": ("BLOQUEANTE", "QUARENTENA", "data_cadastro nula ou fora do formato esperado"),
    "R004_VALOR_NEGATIVO": ("BLOQUEANTE", "QUARENTENA", "gasto, contagem ou salario com valor negativo"),
    "A001_SALARIO_AUSENTE": ("ALERTA", "SINALIZAR", "salario_anual nulo"),
    "A002_SALARIO_OUTLIER": ("ALERTA", "SINALIZAR", "salario_anual acima do limite parametrizado"),
    "A003_ANO_NASCIMENTO_INVALIDO": ("ALERTA", "ANONIMIZAR_CAMPO", "ano de nascimento ausente ou fora da faixa (vira NULL)"),
    "A004_POSSIVEL_DUPLICADO": ("ALERTA", "SINALIZAR", "mesmo conteudo (exceto ID) em mais de um cliente na carga"),
    "A005_DATA_CADASTRO_FUTURA": ("ALERTA", "SINALIZAR", "data_cadastro posterior a data da carga"),
    "A006_DOMINIO_DESCONHECIDO": ("ALERTA", "SINALIZAR", "escolaridade/estado civil fora da lista de dominio"),
    "A007_VALOR_NAO_NUMERICO": ("ALERTA", "SINALIZAR", "campo numerico nao convertido (virou NULL)"),
}

CONFIDENTIAL = ["id_cliente", "ano_nascimento", "salario_anual", "idade"]
STAGE_ORDER = ["preparar", "bronze", "silver", "gold_dimensoes", "gold_fatos", "governanca", "relatorio"]
# ------------------------------------------------------------------------------------------

PARAMETERS = Parameters(DEFAULTS)

COLUMNS = list(CONTRACT.values())
SPEND = [column for _, column in CATEGORIES.values()]
CHANNEL_COUNTS = [column for _, column in CHANNELS.values()]
CAMPAIGN_FLAGS = [column for _, column in CAMPAIGNS.values()]
COUNTS = [
    "qtd_filhos",
    "qtd_adolescentes",
    "dias_desde_ultima_compra",
    "qtd_compras_desconto",
    "visitas_website_mes",
    *CHANNEL_COUNTS,
]

# Order matters: the content hash runs over the typed columns as they stand here.
FIELDS = [
    Field("id_cliente", "bigint"),
    Field("ano_nascimento", "int"),
    Field("escolaridade", "text"),
    Field("estado_civil", "text"),
    Field("pais", "text"),
    Field("salario_anual", "decimal(12,2)"),
    Field("data_cadastro", "date"),
    *[Field(c, "int") for c in COUNTS],
    *[Field(c, "decimal(12,2)") for c in SPEND],
    *[Field(c, "flag") for c in CAMPAIGN_FLAGS],
    Field("comprou", "flag"),
]
CONTENT = [f.name for f in FIELDS if f.name != "id_cliente"]

VERSIONS = scd2.Layout("id_cliente", "sk_cliente", CARRIED, TRACKED)

DAY = ingest.LOAD_DAY
SEQ = ingest.ROW_SEQ
RAW_ID = "id_cliente_raw"


def codes_to_columns(domain: dict[str, tuple[str, str]]) -> dict[str, str]:
    return {code: column for code, (_, column) in domain.items()}


def codes_to_labels(domain: dict[str, tuple[str, str]]) -> dict[str, str]:
    return {code: label for code, (label, _) in domain.items()}


# ---------------------------------------------------------------------------- quality
def ruleset(params: Parameters = PARAMETERS) -> list[Rule]:
    """The rules over the typed frame; limits come from the parameters, the date from the row."""
    day = F.col(DAY)
    conditions = {
        "R001": rules.not_null("id_cliente"),
        "R002": rules.unique("id_cliente", SEQ, quality.FIRST_SEQ),
        "R003": rules.not_null("data_cadastro"),
        "R004": rules.non_negative([*SPEND, *COUNTS, "salario_anual"]),
        "A001": rules.not_null("salario_anual"),
        "A002": rules.max_value("salario_anual", params.get("salario_max_outlier", Decimal)),
        "A003": rules.in_range("ano_nascimento", params.get("ano_nascimento_min", int), F.year(day)),
        "A004": rules.unique_content(quality.COPIES),
        "A005": rules.not_after("data_cadastro", day),
        "A006": rules.in_domain({"escolaridade": list(EDUCATION_ORDER), "estado_civil": MARITAL_STATUS}),
        "A007": rules.all_present([*SPEND, *COUNTS, *CAMPAIGN_FLAGS, "comprou"]),
    }
    return [Rule(code, text, severity, action, conditions[code[:4]]) for code, (severity, action, text) in RULES.items()]


def typed(raw: DataFrame, params: Parameters = PARAMETERS) -> DataFrame:
    """Text rows of one or several loads to types; the row as it came rides along."""
    return coerce.typed(
        raw,
        FIELDS,
        date_format=params.get("formato_data_origem"),
        extra=[DAY, SEQ, F.col("id_cliente").alias(RAW_ID), quality.packed(COLUMNS)],
    )


def evaluate(
    raw: DataFrame,
    params: Parameters = PARAMETERS,
    *,
    stage: Callable[[DataFrame], DataFrame] | None = stored,
    keys: DataFrame | None = None,
    last: Callable[[DataFrame], DataFrame] | None = None,
) -> quality.Split:
    """Typing, rules and split of the rows of one or several loads, each load by itself.

    ``raw`` is read three times, so it should be a stored table. Without staging
    (``stage=None``) everything stays one lazy plan: right for a query that needs a few
    columns of the accepted rows, as unused rules and the copy count then drop out of it. Passing
    stored ``repeated_ids`` as ``keys`` spares such a plan the shuffle of its rows by id.
    """
    return quality.run(
        typed(raw, params),
        ruleset(params),
        key="id_cliente",
        seq=SEQ,
        content=CONTENT,
        within=[DAY],
        stage=stage,
        keys=keys,
        last=last,
    )


def repeated_ids(raw: DataFrame, params: Parameters = PARAMETERS) -> DataFrame:
    """Customer ids that occur more than once in a load; reads two columns of the text rows."""
    return quality.repeated_keys(typed(raw, params), "id_cliente", SEQ, within=[DAY])


def accepted(split: quality.Split, params: Parameters = PARAMETERS) -> DataFrame:
    """Rows without a blocking violation: labels for missing members, totals, alert codes."""
    rule_list = ruleset(params)
    birth_rule = next(r for r in rule_list if r.code.startswith("A003"))
    labelled = coerce.default_labels(split.accepted, ["escolaridade", "estado_civil", "pais"], NOT_GIVEN)
    return labelled.select(
        "id_cliente",
        quality.nullify("ano_nascimento", birth_rule),
        "escolaridade",
        "estado_civil",
        "pais",
        "salario_anual",
        "qtd_filhos",
        "qtd_adolescentes",
        "data_cadastro",
        "dias_desde_ultima_compra",
        *SPEND,
        derive.row_sum(SPEND, "decimal(14,2)").alias("total_gasto"),
        "qtd_compras_desconto",
        *CHANNEL_COUNTS,
        derive.row_sum(CHANNEL_COUNTS, "int").alias("total_compras"),
        "visitas_website_mes",
        *CAMPAIGN_FLAGS,
        derive.row_sum(CAMPAIGN_FLAGS, "int", part_type="int").alias("qtd_campanhas_aceitas"),
        "comprou",
        quality.CONTENT_HASH,
        quality.codes([r for r in rule_list if not r.blocks]).alias("dq_alertas"),
        DAY,
    )


def quarantined(split: quality.Split, params: Parameters = PARAMETERS) -> DataFrame:
    """Rejected rows: the key as it came, the reasons, and the row as it came."""
    blocking = [r for r in ruleset(params) if r.blocks]
    return split.quarantined.select(
        RAW_ID,
        quality.codes(blocking).alias("motivos"),
        F.col(quality.ORIGINAL).alias("linha_original"),
        DAY,
    )


# ---------------------------------------------------------------------------- dimensions
def income_band(params: Parameters = PARAMETERS, salary: str = "salario_anual") -> Column:
    names = ["faixa_salarial_baixa_ate", "faixa_salarial_media_ate", "faixa_salarial_alta_ate"]
    limits = [(params.get(n, Decimal), label) for n, label in zip(names, INCOME_BANDS)]
    return derive.band(
        F.col(salary), limits, above=INCOME_BANDS[-1], missing=NOT_GIVEN, upper_inclusive=True
    )


def age_band(age: Column) -> Column:
    return derive.band(age, AGE_BANDS, above=AGE_ABOVE, missing=NOT_GIVEN, upper_inclusive=False)


def version_source(clean: DataFrame, params: Parameters = PARAMETERS) -> DataFrame:
    """What the versioned customer dimension is built from: one row per customer and load."""
    return scd2.source(clean.withColumn("faixa_salarial", income_band(params)), VERSIONS, DAY)


def country_dim(clean: DataFrame) -> DataFrame:
    return dims.members(clean, "pais", key="sk_pais", default=NOT_GIVEN)


def marital_dim(clean: DataFrame) -> DataFrame:
    return dims.members(clean, "estado_civil", key="sk_estado_civil", default=NOT_GIVEN)


def education_dim(clean: DataFrame) -> DataFrame:
    return dims.ordered_domain(
        clean, "escolaridade", EDUCATION_ORDER, key="sk_escolaridade", default=NOT_GIVEN
    )


def category_dim(spark: SparkSession) -> DataFrame:
    return dims.static(
        spark, codes_to_labels(CATEGORIES), key="sk_categoria", code="cod_categoria", label="categoria"
    )


def channel_dim(spark: SparkSession) -> DataFrame:
    return dims.static(spark, codes_to_labels(CHANNELS), key="sk_canal", code="cod_canal", label="canal")


def campaign_dim(spark: SparkSession) -> DataFrame:
    return dims.static(
        spark, codes_to_labels(CAMPAIGNS), key="sk_campanha", code="cod_campanha", label="campanha"
    )


def calendar_dim(spark: SparkSession, params: Parameters = PARAMETERS) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(params.get("dim_data_inicio")).cast("date").alias("inicio"),
        F.lit(params.get("dim_data_fim")).cast("date").alias("fim"),
    )
    return dims.calendar(bounds, "inicio", "fim", months=MONTHS, weekdays=WEEKDAYS)


# ---------------------------------------------------------------------------- facts
def with_version(clean: DataFrame, dim: DataFrame) -> DataFrame:
    """Accepted rows with the key of the version valid on their load date, and the load's date key."""
    joined = facts.attach_version(clean, dim, VERSIONS, day=DAY)
    return joined.withColumn("sk_data_carga", keys.date_key(F.col(DAY)))


def snapshot_fact(versioned: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    age = F.year(DAY) - F.col("ano_nascimento")
    return facts.snapshot(
        versioned,
        [
            "sk_cliente",
            "id_cliente",
            "sk_data_carga",
            keys.date_key(F.col("data_cadastro")).alias("sk_data_cadastro"),
            keys.hash_key(F.col("pais")).alias("sk_pais"),
            keys.hash_key(F.col("escolaridade")).alias("sk_escolaridade"),
            keys.hash_key(F.col("estado_civil")).alias("sk_estado_civil"),
            age.cast("int").alias("idade"),
            age_band(age).alias("faixa_etaria"),
            "salario_anual",
            "dias_desde_ultima_compra",
            "visitas_website_mes",
            "qtd_compras_desconto",
            *CHANNEL_COUNTS,
            "total_compras",
            "total_gasto",
            "qtd_campanhas_aceitas",
            F.col("comprou").cast("int").alias("comprou"),
            DAY,
            *extra,
        ],
    )


def _domain_fact(
    versioned: DataFrame,
    domain: dict[str, tuple[str, str]],
    extra: Sequence[str] = (),
    *,
    value: str,
    key: str,
    as_type: str | None = None,
) -> DataFrame:
    ids = ["sk_cliente", "sk_data_carga", DAY, *extra]
    return facts.unpivot(
        versioned, ids, codes_to_columns(domain), value=value, key=key, as_type=as_type
    ).drop(facts.CODE)


def category_fact(versioned: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return _domain_fact(versioned, CATEGORIES, extra, value="valor_gasto", key="sk_categoria")


def channel_fact(versioned: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return _domain_fact(versioned, CHANNELS, extra, value="qtd_compras", key="sk_canal")


def campaign_fact(versioned: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return _domain_fact(versioned, CAMPAIGNS, extra, value="aceitou", key="sk_campanha", as_type="int")


def build_facts(versioned: DataFrame) -> dict[str, DataFrame]:
    """The four facts of one or several loads."""
    return {
        "fato_cliente_snapshot": snapshot_fact(versioned),
        "fato_gasto_categoria": category_fact(versioned),
        "fato_compras_canal": channel_fact(versioned),
        "fato_resposta_campanha": campaign_fact(versioned),
    }
