"""Closed versions lie in folders by their last year, which a look at a later day leaves out."""

import re
import shutil
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from snapstrata.operators import scd2
from snapstrata.sources import generations, scratch

LAYOUT = scd2.Layout("id", "sk", ["cor"], ["cor"])


def stored_versions(spark, years=5):
    """An entity a number, each of another colour every year; one generation a load, as loads write them."""
    rows = [(i, f"c{i % 3}-{y}", date(2000 + y, 7, 1)) for i in range(20) for y in range(years)]
    source = scd2.source(spark.createDataFrame(rows, "id bigint, cor string, dia date"), LAYOUT, "dia")
    table = scratch.new_path(spark, "dim")
    moved = scd2.from_history(source.where("dia = '2000-07-01'"), LAYOUT, day="dia")
    schema = scratch.stored(moved).schema
    for y in range(years):
        day = date(2000 + y, 7, 1)
        if y:
            current = generations.read_versions(spark, table, schema, scd2.CURRENT, y).where(scd2.CURRENT)
            moved = scd2.apply_snapshot(current, source.where(F.col("dia") == F.lit(day)).drop("dia"), F.lit(day), LAYOUT)
        generations.write_versions(moved, table, after=y, current=scd2.CURRENT, end=scd2.TO)
    return table, schema, scd2.from_history(source, LAYOUT, day="dia")


def test_folders_that_ended_before_are_not_read(spark):
    table, schema, whole = stored_versions(spark)
    read = lambda **k: generations.read_versions(spark, table, schema, scd2.CURRENT, **k)
    rows = lambda df: sorted(tuple(r) for r in df.select(*LAYOUT.columns).collect())
    assert rows(read()) == rows(whole)
    for day in (date(2000, 7, 1), date(2001, 6, 30), date(2001, 7, 1), date(2002, 12, 31), date(2003, 1, 1), date(2009, 1, 1)):
        assert rows(scd2.as_of(read(since=day), F.lit(day))) == rows(scd2.as_of(whole, F.lit(day))), day
    pruned = scd2.as_of(read(since=date(2003, 1, 1)), F.lit(date(2003, 1, 1)))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*ano_fim", plan)
    folders = sorted({p.parent.name for p in Path(table).rglob("*.parquet")})
    assert folders == [*(f"ano_fim={y}" for y in range(2001, 2005)), "ano_fim=9999"]
    # They may as well be gone; and a join on each row's day needs only what is valid since the first of the days.
    before = rows(pruned)
    for old in Path(table).glob("geracao=*/flag_atual=false/ano_fim=200[12]"):
        shutil.rmtree(old)
    assert rows(scd2.as_of(read(since=date(2003, 1, 1)), F.lit(date(2003, 1, 1)))) == before
    facts = spark.createDataFrame([(i, date(2003, 1, 1) + timedelta(i * 40)) for i in range(20)], "id bigint, dia date")
    joined = lambda dim: sorted(tuple(r) for r in scd2.temporal_join(facts, dim, entity="id", day="dia", columns=["sk"]).collect())
    assert joined(read(since=date(2003, 1, 1))) == joined(whole) and len(joined(whole)) == 20
