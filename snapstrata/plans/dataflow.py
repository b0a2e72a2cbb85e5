"""From a delivered file to the star schema: the layers of the customer preset as tables under one folder.

Each step reads the tables of the step before, replaces its own load's rows, and can be run again
after a failure. Steps are plain functions; when to call them is left to the caller.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.operators import checks, dims, loads, merge, quality, scd2
from snapstrata.operators.params import Parameters
from snapstrata.plans import customers as preset
from snapstrata.sources import generations, ingest, measured, scratch, slices

DAY = ingest.LOAD_DAY

#: Columns of the load state.
STATE = "controle_carga"
STATE_SCHEMA = T.StructType([
    T.StructField(name, kind)
    for name, kind in {
        loads.DAY: T.DateType(), "arquivo": T.StringType(), "caminho": T.StringType(), "tamanho_bytes": T.LongType(), loads.FINGERPRINT: T.StringType(),
        loads.STATUS: T.StringType(), loads.ATTEMPTS: T.IntegerType(), "linhas_bronze": T.LongType(), "linhas_silver": T.LongType(),
        "linhas_quarentena": T.LongType(), "mensagem": T.StringType(), "run_id_ultimo": T.StringType(),
        "criado_em": T.TimestampType(), "atualizado_em": T.TimestampType(),
    }.items()
])

#: Rows of each fact for one of the snapshot, and what is added up while facts are written.
FACT_ROWS = {"fato_gasto_categoria": 6, "fato_compras_canal": 3, "fato_resposta_campanha": 5}
FACT_SUMS = {"fato_cliente_snapshot": "total_gasto", "fato_gasto_categoria": "valor_gasto"}


def fact_measures(name: str) -> dict[str, Column]:
    return {"total": F.sum(FACT_SUMS[name])} if name in FACT_SUMS else {}


def _schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])


def _stamped(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumns({ingest.RUN: F.lit(run_id), "_processado_ts": F.current_timestamp()})


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str
    params: Parameters = preset.PARAMETERS

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # ------------------------------------------------------------------ planning
    def candidates(self, folder: str, skip: DataFrame | None = None) -> DataFrame:
        """Valid files of the landing folder with the fingerprints of their lines.

        ``skip`` has dates (``data_carga``) that need no look, such as those loaded with success. Which files are read is
        said by a pattern and by the first and last name wanted, which leave files out before they are opened, and by a
        semi join with the names: the list itself stays in Spark.
        """
        prefix, extension = (self.params.get(f"arquivo_{x}") for x in ("prefixo", "extensao"))
        found = loads.manifest(loads.discover(self.spark, folder), prefix=prefix, extension=extension).where("nome_valido")
        if skip is not None:
            found = found.join(skip.select(loads.DAY), loads.DAY, "left_anti")
        name = F.lower(F.col("arquivo"))
        first, last = found.agg(F.min(name), F.max(name)).first()
        if first is None:
            return found.drop("nome_valido").withColumn(loads.FINGERPRINT, F.lit(None).cast("string"))
        any_case = "".join(f"[{x.lower()}{x.upper()}]" if x.isalpha() else x for x in f"{prefix}_????????.{extension}")
        lines = self.spark.read.option("pathGlobFilter", any_case).text(folder).select("value", F.col("_metadata.file_name").alias("arquivo"))
        wanted = lines.where(name.between(first, last)).join(found.select("arquivo"), "arquivo", "left_semi")
        return found.join(loads.fingerprint(wanted, ["value"], by=["arquivo"]), "arquivo", "left").drop("nome_valido")

    def badly_named(self, folder: str) -> DataFrame:
        extension = self.params.get("arquivo_extensao")
        files = loads.discover(self.spark, folder)
        listed = loads.manifest(files, prefix=self.params.get("arquivo_prefixo"), extension=extension)
        return listed.where(~F.col("nome_valido")).select("arquivo", F.lit(loads.NOTICE_NAME).alias("aviso"))

    # ------------------------------------------------------------------ bronze
    def bronze(self, file: str, day: date, run_id: str) -> list[str]:
        """Replaces the load's text rows; returns names of columns outside the contract."""
        read = ingest.read_delimited(
            self.spark, file, sep=self.params.get("csv_separador"), encoding=self.params.get("csv_encoding")
        )
        contracted, extra = ingest.apply_contract(read, preset.CONTRACT)
        rows = ingest.numbered(contracted)
        audited = ingest.add_audit(rows, load_day=F.lit(day), source=F.lit(file), run_id=run_id, seq=F.col(ingest.ROW_SEQ))
        ingest.require_rows(slices.replace_slice(audited, self.path("bronze"), day), file)
        return extra

    def bronze_rows(self, day: date) -> DataFrame:
        text = [T.StructField(c, T.StringType()) for c in preset.COLUMNS]
        audit = {
            DAY: T.DateType(),
            ingest.SOURCE_FILE: T.StringType(),
            ingest.INGESTED_AT: T.TimestampType(),
            ingest.RUN: T.StringType(),
            ingest.ROW_SEQ: T.LongType(),
            ingest.ROW_HASH: T.StringType(),
        }
        schema = T.StructType([*text, *[T.StructField(n, t) for n, t in audit.items()]])
        return slices.read_slice(self.spark, self.path("bronze"), day, schema)

    # ------------------------------------------------------------------ silver
    def silver(self, day: date, run_id: str) -> DataFrame:
        """Rule results and quarantine are kept even when the load fails its gate; accepted rows are not.

        What each rule found is counted while the evaluated rows are stored.
        """
        rules, found = preset.ruleset(self.params), {}

        def kept(evaluated: DataFrame) -> DataFrame:
            rows, figures = measured.stored(evaluated, "avaliadas", **quality.counts(rules))
            found.update(figures)
            return rows

        split = preset.evaluate(self.bronze_rows(day), self.params, last=kept)
        summary = self.spark.range(1).select(
            F.lit(day).alias(DAY), *[F.lit(n).cast("bigint").alias("total" if name == measured.ROWS else name) for name, n in found.items()]
        )
        results = quality.results(summary, rules, by=[DAY]).withColumn("tabela", F.lit("silver.marketing_cliente"))
        slices.append_part(_stamped(results, run_id), self.path("dq_resultado"), day, run_id)
        slices.write_slice(_stamped(preset.quarantined(split, self.params), run_id), self.path("quarentena"), day)
        quality.require_gate(quality.gate(summary, self.params.get("limite_rejeicao_pct", float)))
        clean = _stamped(preset.accepted(split, self.params), run_id)
        slices.write_slice(clean, self.path("silver"), day)
        return slices.read_slice(self.spark, self.path("silver"), day, _schema(clean))

    def rule_results(self) -> DataFrame:
        """Rule results of every run of every load."""
        kinds = {"total": T.LongType(), "falhas": T.LongType(), "pct_falha": T.DoubleType(), "_processado_ts": T.TimestampType()}
        names = ["regra", "descricao", "severidade", "acao", "total", "falhas", "pct_falha", "tabela", ingest.RUN, "_processado_ts"]
        schema = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
        return slices.read_parts(self.spark, self.path("dq_resultado"), schema)

    # ------------------------------------------------------------------ dimensions
    def _rewrite(self, table: str, fresh: DataFrame, key: str, *, fixed: bool = False) -> DataFrame:
        """The stored dimension with new members; of a ``fixed`` domain labels are also brought up to date."""
        path, schema = self.path(table), _schema(fresh)
        number = generations.latest(self.spark, path)
        old = generations.read_latest(self.spark, path, schema, number)
        moved = merge.upsert(old, fresh, [key]) if fixed else dims.grow(old, fresh, key)
        written = generations.write_next(moved, path, after=number)
        generations.drop_superseded(self.spark, path, written)
        return generations.read_latest(self.spark, path, schema)

    def dimensions(self, clean: DataFrame, day: date) -> dict[str, DataFrame]:
        """Growing dimensions, the calendar (filled once), and the versioned customers."""
        out = {
            "dim_pais": self._rewrite("dim_pais", preset.country_dim(clean), "sk_pais"),
            "dim_escolaridade": self._rewrite("dim_escolaridade", preset.education_dim(clean), "sk_escolaridade"),
            "dim_estado_civil": self._rewrite("dim_estado_civil", preset.marital_dim(clean), "sk_estado_civil"),
            "dim_categoria_produto": self._rewrite("dim_categoria_produto", preset.category_dim(self.spark), "sk_categoria", fixed=True),
            "dim_canal": self._rewrite("dim_canal", preset.channel_dim(self.spark), "sk_canal", fixed=True),
            "dim_campanha": self._rewrite("dim_campanha", preset.campaign_dim(self.spark), "sk_campanha", fixed=True),
        }
        fresh, path = preset.calendar_dim(self.spark, self.params), self.path("dim_data")
        number = generations.latest(self.spark, path)
        filled = dims.calendar_if_empty(generations.read_latest(self.spark, path, _schema(fresh), number), fresh)
        if filled is fresh:
            generations.write_next(fresh, path, after=number)
        out["dim_data"] = generations.read_latest(self.spark, path, _schema(fresh))
        out["dim_cliente"] = self._customer_versions(clean, day)
        return out

    def _customer_versions(self, clean: DataFrame, day: date) -> DataFrame:
        layout, path = preset.VERSIONS, self.path("dim_cliente")
        source = preset.version_source(clean, self.params).drop(DAY)
        first = scd2.from_history(preset.version_source(clean, self.params), layout, day=DAY)
        schema = _schema(first)
        number = generations.latest(self.spark, path)
        if number == 0:
            moved = first
        else:
            current = generations.read_versions(self.spark, path, schema, scd2.CURRENT, number)
            moved = scd2.apply_snapshot(current.where(scd2.CURRENT), source, F.lit(day), layout)
        written = generations.write_versions(moved, path, after=number, current=scd2.CURRENT, end=scd2.TO)
        generations.drop_superseded(self.spark, path, written, scd2.CURRENT)
        return generations.read_versions(self.spark, path, schema, scd2.CURRENT)

    def versions_since(self, dim: DataFrame, day: date) -> DataFrame:
        """The customer versions of the newest generation, without the folders of those that ended in years before the day."""
        return generations.read_versions(self.spark, self.path("dim_cliente"), _schema(dim), scd2.CURRENT, since=day)

    # ------------------------------------------------------------------ facts
    def facts(self, clean: DataFrame, dim: DataFrame, day: date, run_id: str) -> dict[str, DataFrame]:
        """The version join is stored once and read by all four facts; none is written if it lost a row.

        Of the versions only those valid on the day are joined; ``dim`` tells their columns.
        """
        valid = scd2.as_of(self.versions_since(dim, day), F.lit(day))
        base, joined = measured.stored(preset.with_version(clean, valid), "base_fatos")
        counted = measured.row(self.spark, aceitas=self._figures("silver", clean, day), base=joined)
        checks.require(checks.compared(counted, [checks.adds_up("cada linha aceita acha a sua versao", "aceitas_linhas", "base_linhas")]))
        out = {}
        for name, fact in preset.build_facts(base).items():
            stamped = fact.withColumns({ingest.RUN: F.lit(run_id), "_carga_ts": F.current_timestamp()})
            slices.write_slice(stamped, self.path(name), day, **fact_measures(name))
            out[name] = slices.read_slice(self.spark, self.path(name), day, _schema(stamped))
        return out

    def _figures(self, name: str, rows: DataFrame, day: date) -> measured.Figures:
        return slices.figures(self.spark, self.path(name), day, _schema(rows), **fact_measures(name))

    # ------------------------------------------------------------------ load state
    def state(self) -> DataFrame:
        """A row per registered load."""
        return generations.read_latest(self.spark, self.path(STATE), STATE_SCHEMA)

    def _keep_state(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """The next generation of the state, made from the one that counts."""
        path = self.path(STATE)
        number = generations.latest(self.spark, path)
        old = generations.read_latest(self.spark, path, STATE_SCHEMA, number)
        changed = change(old).select(*[F.col(f.name).cast(f.dataType) for f in STATE_SCHEMA.fields])
        generations.write_next(changed, path, after=number)
        generations.drop_superseded(self.spark, path, number + 1)

    def plan(self, folder: str, run_id: str, request: loads.Request = loads.Request()) -> DataFrame:
        """Decides what to do with each file of the folder, and registers the loads that are planned or refused."""
        state = self.state()
        done = state.where(F.col(loads.STATUS) == loads.SUCCESS) if request.day is None else None
        planned = scratch.stored(loads.plan(self.candidates(folder, done), state, request), "plano")
        loads.require_plan(planned, state, request)
        self._keep_state(lambda known: loads.register(known, planned, run_id, F.current_timestamp()))
        return planned

    def _advance(self, day: date, stage: str, *, message: str | None = None, **counts: int) -> None:
        fields = ["linhas_bronze", "linhas_silver", "linhas_quarentena"]
        outcome = self.spark.range(1).select(
            F.lit(day).alias(loads.DAY), F.lit(stage).alias("etapa"), F.lit(message is None).alias("ok"),
            F.lit(message).cast("string").alias("mensagem"), *[F.lit(counts.get(c)).cast("bigint").alias(c) for c in fields],
        )
        touched = F.when(F.col(loads.DAY) == F.lit(day), F.current_timestamp()).otherwise(F.col("atualizado_em"))
        self._keep_state(lambda known: loads.advance(known, outcome).withColumn("atualizado_em", touched))

    def load_all(self, folder: str, run_id: str, request: loads.Request = loads.Request()) -> DataFrame:
        """Plans, then takes the planned loads from stage to stage, oldest first; returns the run's loads with their states.

        A load that fails in a stage gets that stage's error state and the message, by itself; the others of the stage go
        on. No later stage begins then: the next run plans what is not done again.
        """
        planned = self.plan(folder, run_id, request).where("decisao = 'planejar'")
        # One at a time, as each is a chain of jobs, and the versions of one build on those of the one before.
        files = {r[loads.DAY]: r["caminho"] for r in planned.select(loads.DAY, "caminho").orderBy(loads.DAY).toLocalIterator()}
        made: dict[date, dict[str, DataFrame]] = {day: {} for day in files}
        for stage in loads.STAGES:
            failed = [day for day in files if not self._stage(stage, files[day], day, run_id, made[day])]
            if failed:
                break
        return self.state().where(F.col("run_id_ultimo") == run_id)

    def _stage(self, stage: str, file: str, day: date, run_id: str, made: dict[str, DataFrame]) -> bool:
        """One stage of one load, and its outcome in the load state."""
        counted = lambda *tables: {f"linhas_{t}": slices.rows(self.spark, self.path(t), day) for t in tables}
        counts: dict[str, int] = {}
        try:
            with scratch.passing(self.spark):
                if stage == "bronze":
                    self.bronze(file, day, run_id)
                    counts = counted("bronze")
                elif stage == "silver":
                    made["silver"] = self.silver(day, run_id)
                    counts = counted("silver", "quarentena")
                elif stage == "gold_dimensoes":
                    made.update(self.dimensions(made["silver"], day))
                else:
                    made.update(self.facts(made["silver"], made["dim_cliente"], day, run_id))
        except Exception as fault:  # noqa: BLE001 - whatever it is, the load's state tells it
            self._advance(day, stage, message=f"{type(fault).__name__}: {fault}"[:1000])
            return False
        self._advance(day, stage, **counts)
        return True

    # ------------------------------------------------------------------ whole load
    def process(self, file: str, day: date, run_id: str) -> dict[str, DataFrame]:
        """All layers of one load; returns its tables by name. Intermediates are gone at the end."""
        with scratch.passing(self.spark):
            self.bronze(file, day, run_id)
            clean = self.silver(day, run_id)
            dimensions = self.dimensions(clean, day)
            facts = self.facts(clean, dimensions["dim_cliente"], day, run_id)
        return {"bronze": self.bronze_rows(day), "silver": clean, **dimensions, **facts}

    def verify(self, tables: dict[str, DataFrame], day: date) -> DataFrame:
        """Reconciliation of one load over its tables.

        Rows and sums are those their writes have left; only the snapshot and the versions are read, once each.
        """
        snapshot, dim = tables["fato_cliente_snapshot"], tables["dim_cliente"]
        rejected = self.spark.createDataFrame([], T.StructType([T.StructField(preset.RAW_ID, T.StringType())]))
        figures = {name: self._figures(name, tables[name], day) for name in ("bronze", "silver", "fato_cliente_snapshot", *FACT_ROWS)}
        figures["quarentena"] = self._figures("quarentena", rejected, day)
        owners: checks.Roles = {"sk_cliente": (dim, "sk_cliente")}
        owners |= {f"sk_{k}": (tables[f"dim_{k}"], f"sk_{k}") for k in ("pais", "escolaridade", "estado_civil")}
        days = {c: (tables["dim_data"], "sk_data") for c in ("sk_data_carga", "sk_data_cadastro")}
        figures["orfas"] = checks.orphan_rows(snapshot, {"membros": owners, "datas": days}).first().asDict()
        figures["versoes"] = checks.version_figures(dim, "id_cliente", "sk_cliente").first().asDict()
        base = "fato_cliente_snapshot_linhas"
        return checks.compared(
            measured.row(self.spark, **figures),
            [
                checks.some("o arquivo trouxe linhas", "bronze_linhas"),
                checks.adds_up("toda linha recebida foi aceita ou retida", "bronze_linhas", "silver_linhas", "quarentena_linhas"),
                checks.adds_up("cada cliente aceito tem uma linha de fato", "silver_linhas", base),
                *[checks.adds_up(f"{n} linhas por cliente em {name}", f"{name}_linhas", base, times=n) for name, n in FACT_ROWS.items()],
                checks.same_amount("os dois fatos somam o mesmo gasto", "fato_cliente_snapshot_total", "fato_gasto_categoria_total"),
                checks.none("nenhum cliente com duas versoes abertas", "versoes_atuais"),
                checks.none("nenhuma versao acaba antes de comecar", "versoes_invalidas"),
                checks.none("cada versao comeca onde a anterior acaba", "versoes_quebras"),
                checks.none("nenhuma chave de versao serve a duas linhas", "versoes_repetidas"),
                checks.none("todo fato acha os seus membros", "orfas_membros"),
                checks.none("todo fato acha as suas datas", "orfas_datas"),
            ],
        )
