"""Rows of the customer contract: one valid customer, overridden field by field."""

from datetime import date

from pyspark.sql import functions as F

from snapstrata.plans import customers as preset
from snapstrata.sources import ingest

DAY = date(2026, 9, 20)

#: Spend, counts and flags of the valid customer, in the order of the contract.
_SPEND = (41, 26, 70, 15, 30, 20)
_COUNTS = {"qtd_compras_desconto": 1, "qtd_compras_web": 2, "qtd_compras_catalogo": 3, "qtd_compras_loja": 4}

VALID = (
    dict.fromkeys(preset.COLUMNS, "0")
    | {c: str(v) for c, v in zip(preset.SPEND, _SPEND)}
    | {c: str(v) for c, v in _COUNTS.items()}
    | dict.fromkeys([preset.CAMPAIGN_FLAGS[1], preset.CAMPAIGN_FLAGS[4], "comprou"], "1")
    | {"id_cliente": "1", "ano_nascimento": "1968", "escolaridade": "Doutorado", "estado_civil": "Solteiro"}
    | {"salario_anual": "48200", "data_cadastro": "3/11/2020", "pais": "Uruguai"}
)


def raw(spark, overrides, day=DAY):
    """Text rows with load date and sequence; each entry overrides fields of the valid customer."""
    rows = [
        tuple({**VALID, **change}[c] for c in preset.COLUMNS) + (seq,) for seq, change in enumerate(overrides)
    ]
    schema = ", ".join(f"{c} string" for c in preset.COLUMNS) + f", {ingest.ROW_SEQ} bigint"
    return spark.createDataFrame(rows, schema).withColumn(ingest.LOAD_DAY, F.lit(day))


def by_id(df):
    return {r["id_cliente"]: r for r in df.collect()}
