"""Load state: which files make up the next run, and how a load moves from stage to stage.

The state table has a row per load date, so it grows by a row per delivery, not with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.functions import derive
from snapstrata.operators import merge

DAY, STATUS, ATTEMPTS, FINGERPRINT = "data_carga", "status", "tentativas", "impressao"

# States of a load and the codes of planning notices.
PENDING = "PENDENTE"
SUCCESS = "SUCESSO"
OUT_OF_ORDER = "ERRO_FORA_DE_ORDEM"
ERROR_PREFIX = "ERRO"
STAGES = {
    "bronze": ("PENDENTE", "BRONZE_OK", "ERRO_BRONZE"),
    "silver": ("BRONZE_OK", "SILVER_OK", "ERRO_SILVER"),
    "gold_dimensoes": ("SILVER_OK", "DIMENSOES_OK", "ERRO_DIMENSOES"),
    "gold_fatos": ("DIMENSOES_OK", "SUCESSO", "ERRO_FATOS"),
}
NOTICE_ATTEMPTS = "MAX_TENTATIVAS"
NOTICE_ORDER = "ARQUIVO_FORA_DE_ORDEM"
NOTICE_COPY = "ARQUIVO_CONTEUDO_DUPLICADO"
NOTICE_NAME = "ARQUIVO_NOME_INVALIDO"

#: Hex digits of a digest that are added up as one number: 52 bits, five of them to a digest.
DIGEST_WORD = 13


class LoadRefused(ValueError):
    """The requested load cannot be planned."""


# ---------------------------------------------------------------------------- discovery
def discover(spark: SparkSession, folder: str) -> DataFrame:
    """Path, name and size of the files in a folder, none if it is not there; the content is never read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "caminho string, arquivo string, tamanho_bytes bigint")
    files = spark.read.format("binaryFile").load(folder)
    return files.select(
        F.col("path").alias("caminho"),
        F.element_at(F.split("path", "/"), -1).alias("arquivo"),
        F.col("length").alias("tamanho_bytes"),
    )


def expected_name(day: Column, prefix: str, extension: str) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.date_format(day, "yyyyMMdd"), F.lit(f".{extension}"))


def name_date(name: Column, prefix: str, extension: str) -> Column:
    """Date in ``<prefix>_YYYYMMDD.<extension>``, any case; NULL for other names and impossible dates."""
    digits = F.regexp_extract(name, rf"(?i)^\Q{prefix}\E_([0-9]{{8}})\.\Q{extension}\E$", 1)
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd")).cast("date")


def manifest(files: DataFrame, *, prefix: str, extension: str) -> DataFrame:
    """Files with the extension, their load date, and whether the name is valid."""
    tail = F.lower(F.col("arquivo")).endswith(f".{extension}".lower())
    day = name_date(F.col("arquivo"), prefix, extension)
    return files.where(tail).withColumn(DAY, day).withColumn("nome_valido", F.col(DAY).isNotNull())


def fingerprint(df: DataFrame, columns: Sequence[str], *, by: Sequence[str] = ()) -> DataFrame:
    """Fingerprint of the rows of a load: row count and the sums of all parts of their digests.

    It does not depend on the order of rows, on file splits or on line endings, so a resent file
    with shuffled rows has the same fingerprint; a file hash would differ.
    """
    digest = derive.digest(columns, sep="||")
    words = [F.conv(F.substring(digest, at, DIGEST_WORD), 16, 10).cast("decimal(20,0)") for at in range(1, 65, DIGEST_WORD)]
    sums = [F.coalesce(F.sum(w).cast("string"), F.lit("0")) for w in words]
    return df.groupBy(*by).agg(F.concat_ws("-", F.count(F.lit(1)).cast("string"), *sums).alias(FINGERPRINT))


# ---------------------------------------------------------------------------- planning
@dataclass(frozen=True)
class Request:
    """``day`` None takes every file; a date takes that file only, again if ``reprocess``."""

    day: date | None = None
    reprocess: bool = False
    max_attempts: int = 3

    @property
    def redo(self) -> bool:
        return self.day is not None and self.reprocess


def last_success(state: DataFrame) -> DataFrame:
    """Latest and next-to-latest successful load date, as one row."""
    done = state.where(F.col(STATUS) == SUCCESS).select(DAY).orderBy(F.col(DAY).desc()).limit(2)
    return done.agg(
        F.max(DAY).alias("ultima"),
        F.when(F.count(F.lit(1)) > 1, F.min(DAY)).alias("anterior"),
    )


def _two_first_days(state: DataFrame) -> DataFrame:
    """The two earliest load dates of each fingerprint, enough to name a copy of any one load, and their number."""
    known = state.where(F.col(FINGERPRINT).isNotNull()).select(FINGERPRINT, DAY)
    first = known.groupBy(FINGERPRINT).agg(F.min(DAY).alias("_copia_1"), F.count(F.lit(1)).alias("_cargas"))
    later = known.join(first, FINGERPRINT).where(F.col(DAY) > F.col("_copia_1"))
    second = later.groupBy(FINGERPRINT).agg(F.min(DAY).alias("_copia_2"))
    return first.join(second, FINGERPRINT, "left")


def plan(candidates: DataFrame, state: DataFrame, request: Request) -> DataFrame:
    """What to do with each file: ``decisao`` is ``planejar``, ``recusar`` or ``pular``.

    ``candidates`` has date, name, path, size and fingerprint of the valid files; ``state`` has
    date, status, attempts and fingerprint of the registered loads. A copy is only looked for
    among registered loads, not among files of the same run; ``copia_de`` names the earliest and
    ``copias`` says how many there are, which ``copies_of`` lists.
    """
    day = F.col(DAY)
    if request.day is not None:
        candidates = candidates.where(day == F.lit(request.day))
    known = state.select(
        DAY, F.col(STATUS).alias("_status"), F.col(ATTEMPTS).alias("_tentativas"), F.col(FINGERPRINT).alias("_conteudo")
    ).withColumn("_registrada", F.lit(True))
    newest = last_success(state).select("ultima").scalar()
    facts = (
        candidates.join(known, DAY, "left")
        .join(_two_first_days(state), FINGERPRINT, "left")
        .withColumn("_ultima", newest)
    )

    auto = F.lit(request.day is None)
    status = F.coalesce(F.col("_status"), F.lit(""))
    seen = F.coalesce(F.col("_registrada"), F.lit(False))
    done = (status == SUCCESS) & F.lit(not request.redo)
    dropped = auto & (status == OUT_OF_ORDER)
    worn_out = (
        auto
        & status.startswith(ERROR_PREFIX)
        & (F.coalesce(F.col("_tentativas"), F.lit(0)) >= request.max_attempts)
    )
    skipped = done | dropped | worn_out
    late = ~seen & F.coalesce(day < F.col("_ultima"), F.lit(False))
    copy_of = F.when(F.col("_copia_1") != day, F.col("_copia_1")).otherwise(F.col("_copia_2"))
    copied = copy_of.isNotNull() & ~late
    own = F.coalesce(F.col("_conteudo") == F.col(FINGERPRINT), F.lit(False)).cast("int")
    others = F.coalesce(F.col("_cargas"), F.lit(0)) - own
    attempt = F.lit(1) if request.redo else F.coalesce(F.col("_tentativas"), F.lit(0)) + 1
    too_late = F.concat(F.lit("Anterior a ultima carga com sucesso ("), F.col("_ultima").cast("string"), F.lit(")"))

    return facts.select(
        *candidates.columns,
        F.when(skipped, "pular").when(late, "recusar").otherwise("planejar").alias("decisao"),
        F.when(skipped, F.col("_status")).when(late, OUT_OF_ORDER).otherwise(PENDING).alias(STATUS),
        F.when(skipped, F.col("_tentativas")).otherwise(attempt).cast("int").alias(ATTEMPTS),
        F.when(~skipped & late, too_late).alias("mensagem"),
        F.when(~skipped & copied, copy_of).alias("copia_de"),
        F.when(~skipped & copied, others).otherwise(F.lit(0)).cast("bigint").alias("copias"),
        F.array_compact(
            F.array(
                F.when(~done & ~dropped & worn_out, NOTICE_ATTEMPTS),
                F.when(~skipped & late, NOTICE_ORDER),
                F.when(~skipped & copied, NOTICE_COPY),
            )
        ).alias("avisos"),
    )


def copies(state: DataFrame) -> DataFrame:
    """Registered loads whose content another load has too, one row per load."""
    repeated = state.groupBy(FINGERPRINT).agg(F.count(F.lit(1)).alias("cargas")).where(F.col("cargas") > 1)
    return state.select(DAY, FINGERPRINT).join(repeated, FINGERPRINT, "inner")


def copies_of(planned: DataFrame, state: DataFrame) -> DataFrame:
    """Every registered load with the content of a planned one: date of the load, date of its copy."""
    known = state.select(FINGERPRINT, F.col(DAY).alias("copia"))
    return planned.where("copias > 0").select(DAY, FINGERPRINT).join(known, FINGERPRINT).where(F.col("copia") != F.col(DAY)).select(DAY, "copia")


def require_plan(planned: DataFrame, state: DataFrame, request: Request) -> None:
    """Raises when the requested date has no file, or would be redone behind a later success."""
    if request.day is None:
        return
    if planned.isEmpty():
        raise LoadRefused(f"no file for load {request.day}")
    newest = last_success(state).first()["ultima"]
    if request.redo and newest is not None and request.day < newest:
        raise LoadRefused(f"load {request.day} is older than the last success ({newest})")


def register(state: DataFrame, planned: DataFrame, run_id: str, now: Column) -> DataFrame:
    """The state table with the planned and refused loads written in; counts and first time are kept."""
    rows = planned.where(F.col("decisao") != "pular").select(
        *[c for c in planned.columns if c in state.columns],
        F.lit(run_id).alias("run_id_ultimo"),
        now.alias("criado_em"),
        now.alias("atualizado_em"),
    )
    return merge.upsert(state, rows, [DAY], keep=["criado_em"])


# ---------------------------------------------------------------------------- progress
def in_state(state: DataFrame, run_id: str, status: str) -> DataFrame:
    """Loads of a run in a state, oldest first."""
    mine = (F.col("run_id_ultimo") == run_id) & (F.col(STATUS) == status)
    return state.where(mine).orderBy(DAY)


def stage_active(stages: DataFrame, loads_by_stage: DataFrame) -> DataFrame:
    """Adds the switch of each row's stage; a stage without a row in the table is on."""
    switch = stages.select("etapa", F.col("ativo").alias("_ativo"))
    return loads_by_stage.join(switch, "etapa", "left").withColumn(
        "etapa_ativa", F.coalesce(F.col("_ativo"), F.lit(True))
    ).drop("_ativo")


def advance(
    state: DataFrame,
    outcomes: DataFrame,
    *,
    stages: Mapping[str, tuple[str, str, str]] = STAGES,
    counts: Sequence[str] = ("linhas_bronze", "linhas_silver", "linhas_quarentena"),
) -> DataFrame:
    """The state after a stage ran: outcomes have date, ``etapa``, ``ok``, ``mensagem`` and counts.

    Only a load that waits for that stage moves. Success moves it on and writes the counts that
    are given; a failure puts that load alone into the stage's error state with its message.
    """
    table = F.create_map(
        *[
            x
            for name, (entry, passed, failed) in stages.items()
            for x in (F.lit(name), F.struct(F.lit(entry).alias("entrada"), F.lit(passed).alias("bom"), F.lit(failed).alias("ruim")))
        ]
    )
    step = F.try_element_at(table, F.col("etapa"))
    result = outcomes.select(
        DAY,
        F.col("ok").alias("_ok"),
        step["entrada"].alias("_entrada"),
        F.when(F.col("ok"), step["bom"]).otherwise(step["ruim"]).alias("_status"),
        F.col("mensagem").alias("_mensagem"),
        *[F.col(c).alias(f"_{c}") for c in counts],
    )
    joined = state.join(result, DAY, "left")
    moves = F.coalesce(F.col("_entrada") == F.col(STATUS), F.lit(False))
    passes, fails = moves & F.col("_ok"), moves & ~F.col("_ok")
    changed = {
        STATUS: F.when(moves, F.col("_status")).otherwise(F.col(STATUS)),
        "mensagem": F.when(fails, F.col("_mensagem")).otherwise(F.col("mensagem")),
        **{c: F.when(passes, F.coalesce(F.col(f"_{c}"), F.col(c))).otherwise(F.col(c)) for c in counts},
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in state.columns])
