"""Tables as folders of load slices: ``<table>/_data_carga=<date>/<version>``.

A slice is replaced by writing its next version beside the one that counts. The newest version with the job's
success marker is what readers take, so a job that dies changes nothing, a frame may replace the slice it was
read from, and an empty version empties the slice. The version before the newest stays for readers at work.

A version keeps the figures of its rows, taken while they were written, beside its files.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.sources import measured

SLICE = "_data_carga"
VERSION = "_versao"
PART = "_execucao"
#: Both names are hidden from Spark's readers.
MARKER, FIGURES = "_SUCCESS", "_medidas.json"


def slice_path(table: str, day: date) -> str:
    return f"{table}/{SLICE}={day.isoformat()}"


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    place, files = _place(spark, pattern)
    return [x.getPath().toString() for x in files.globStatus(place) or ()]


def _finished(spark: SparkSession, pattern: str) -> list[str]:
    """Folders under a pattern whose job has ended well, from one listing."""
    return [x.rsplit("/", 1)[0] for x in _matching(spark, f"{pattern}/{MARKER}")]


def _number(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


def _put(spark: SparkSession, path: str, text: str = "") -> None:
    place, files = _place(spark, path)
    out = files.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def _drop(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        place, files = _place(spark, path)
        files.delete(place, True)


def write_slice(df: DataFrame, table: str, day: date, **measures: Column) -> measured.Figures:
    """Replaces the rows of one load and returns their figures, the number of rows among them, from the write itself."""
    spark, path = df.sparkSession, slice_path(table, day)
    before = sorted(_finished(spark, f"{path}/{VERSION}=*"), key=_number)
    version = f"{path}/{VERSION}={_number(before[-1]) + 1 if before else 1}"
    watched, seen = measured.observed(df.drop(SLICE), **measures)
    watched.write.mode("overwrite").parquet(version)
    figures = seen.get
    _put(spark, f"{version}/{FIGURES}", json.dumps(figures, default=str))
    _drop(spark, before[:-1])
    return figures


def replace_slice(df: DataFrame, table: str, day: date) -> int:
    """Replaces the rows of one load and returns how many there are now."""
    return write_slice(df, table, day)[measured.ROWS]


def figures(spark: SparkSession, table: str, day: date, schema: T.StructType, **measures: Column) -> measured.Figures:
    """Figures of a slice as they were taken when it was written; a version that lacks one of them is read for it."""
    finished = sorted(_finished(spark, f"{slice_path(table, day)}/{VERSION}=*"), key=_number)
    kept: measured.Figures = {}
    place, files = _place(spark, f"{finished[-1]}/{FIGURES}" if finished else table)
    if finished and files.exists(place):
        stream = files.open(place)
        try:
            kept = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
    if not {measured.ROWS, *measures} <= set(kept):
        wanted = [F.count(F.lit(1)).alias(measured.ROWS), *[c.alias(n) for n, c in measures.items()]]
        return read_slice(spark, table, day, schema).agg(*wanted).first().asDict()
    return {n: kept[n] for n in (measured.ROWS, *measures)}


def rows(spark: SparkSession, table: str, day: date) -> int:
    """How many rows a slice has."""
    return figures(spark, table, day, T.StructType([]))[measured.ROWS]


def write_slices(df: DataFrame, table: str, *, day: str = SLICE, emptied: Iterable[date] = (), **measures: Column) -> measured.Figures:
    """Replaces the slices of all days in ``day`` by one job, and those ``emptied`` by none; returns the figures of all rows.

    All new versions have one number, above any that is there, finished or not. Their markers are set when the job
    has ended well: until then no slice is changed, and each slice by itself is either old or new. Rows are dealt by
    day, a day of many rows to several files. Days without rows that are not ``emptied`` stay as they are, as do rows
    without a day.
    """
    spark = df.sparkSession
    there = _matching(spark, f"{table}/{SLICE}=*/{VERSION}=*")
    number = max(map(_number, there), default=0) + 1
    named = df if day == SLICE else df.drop(SLICE).withColumnRenamed(day, SLICE)
    dealt = named.where(F.col(SLICE).isNotNull()).withColumn(VERSION, F.lit(number)).hint("rebalance", SLICE)
    watched, seen = measured.observed(dealt, **measures)
    watched.write.mode("append").partitionBy(SLICE, VERSION).parquet(table)
    written = _matching(spark, f"{table}/{SLICE}=*/{VERSION}={number}")
    written += [f"{slice_path(table, d)}/{VERSION}={number}" for d in emptied]
    for version in written:
        _put(spark, f"{version}/{MARKER}")
    changed = {x.rsplit("/", 1)[0] for x in written}
    older: dict[str, list[str]] = {}
    for path in sorted(there, key=_number):
        older.setdefault(path.rsplit("/", 1)[0], []).append(path)
    _drop(spark, [p for folder, paths in older.items() if folder in changed for p in paths[:-1]])
    return seen.get


def append_part(df: DataFrame, table: str, day: date, part: str) -> None:
    """Adds the rows of one run to a load; the same run again replaces its own rows only."""
    df.drop(SLICE).write.mode("overwrite").parquet(f"{slice_path(table, day)}/{PART}={part}")


def _read(spark: SparkSession, table: str, paths: list[str], schema: T.StructType) -> DataFrame:
    fields = [f for f in schema.fields if f.name not in (SLICE, VERSION, PART)] + [T.StructField(SLICE, T.DateType())]
    wanted = T.StructType(fields)
    if not paths:
        return spark.createDataFrame([], wanted)
    return spark.read.schema(wanted).option("basePath", table).parquet(*paths).select(*wanted.fieldNames())


def _newest(spark: SparkSession, pattern: str) -> list[str]:
    newest: dict[str, str] = {}
    for path in sorted(_finished(spark, f"{pattern}/{VERSION}=*"), key=_number):
        newest[path.rsplit("/", 1)[0]] = path
    return list(newest.values())


def days(spark: SparkSession, table: str) -> list[date]:
    """The loads a table has slices of, oldest first."""
    return sorted(date.fromisoformat(p.rsplit("/", 2)[1].split("=", 1)[1]) for p in _newest(spark, f"{table}/{SLICE}=*"))


def read_table(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """All slices in their newest version; the schema is the contract, it is never inferred.

    The slice column is a partition column: a filter on it leaves folders out, and so does, at run time, a join with a
    small frame of days.
    """
    return _read(spark, table, _newest(spark, f"{table}/{SLICE}=*"), schema)


def read_slice(spark: SparkSession, table: str, day: date, schema: T.StructType) -> DataFrame:
    """One load's rows; no other slice is even listed."""
    return _read(spark, table, _newest(spark, slice_path(table, day)), schema).where(F.col(SLICE) == F.lit(day))


def read_slices(spark: SparkSession, table: str, days: Iterable[date], schema: T.StructType) -> DataFrame:
    """The rows of some loads; of the others nothing is listed."""
    return _read(spark, table, [p for d in days for p in _newest(spark, slice_path(table, d))], schema)


def read_parts(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows of all runs that were appended."""
    return _read(spark, table, _finished(spark, f"{table}/{SLICE}=*/{PART}=*"), schema)
