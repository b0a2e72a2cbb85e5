"""Tables that are rewritten as a whole: a folder per generation, the newest finished one counts.

A rewrite never touches what it reads, and a job that dies leaves a folder without the job's success
marker, which nobody reads and the next attempt overwrites.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GENERATION = "geracao"


def latest(spark: SparkSession, table: str) -> int:
    """Number of the newest finished generation, 0 when there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(table)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return 0
    names = [entry.getPath().getName() for entry in files.listStatus(root)]
    numbers = sorted((int(n.split("=")[1]) for n in names if n.startswith(f"{GENERATION}=")), reverse=True)
    # Newest first: one or two looks for the marker, however many generations there are.
    marker = lambda n: spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{GENERATION}={n}/_SUCCESS")
    return next((n for n in numbers if files.exists(marker(n))), 0)


def write_next(df: DataFrame, table: str, *, after: int, partition_by: tuple[str, ...] = ()) -> int:
    """Writes the generation that follows ``after``, the one the frame was computed from."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{table}/{GENERATION}={after + 1}")
    return after + 1


def read_latest(spark: SparkSession, table: str, schema: T.StructType, number: int | None = None) -> DataFrame:
    """The newest generation (or the given one); an empty frame before the first."""
    number = latest(spark, table) if number is None else number
    if number == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table}/{GENERATION}={number}")


def drop_superseded(spark: SparkSession, table: str, number: int, current: str | None = None) -> None:
    """Removes what no reader of generation ``number`` or the one before needs.

    Of a table of versions (``current`` names its mark) that is the current rows of older generations;
    of others the older generations.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(table)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for old in range(number - 2, 0, -1):
        place = f"{table}/{GENERATION}={old}" + (f"/{current}=true" if current else "")
        if not files.delete(spark._jvm.org.apache.hadoop.fs.Path(place), True):
            break  # gone since an earlier load, and with it all before


#: Folder of closed versions by the year they end in.
END_YEAR = "ano_fim"


def write_versions(df: DataFrame, table: str, *, after: int, current: str, end: str) -> int:
    """The next generation of a versioned table: current rows, and those it closed by the year of their last day.

    A row that ends on day d is of use to days up to d only, so a reader that looks back to a day leaves out the
    folders of all years before it.
    """
    return write_next(df.withColumn(END_YEAR, F.year(end)), table, after=after, partition_by=(current, END_YEAR))


def read_versions(
    spark: SparkSession, table: str, schema: T.StructType, current: str, number: int | None = None, *, since: date | None = None
) -> DataFrame:
    """A versioned table whose generations hold all current rows and only the rows closed then.

    Current rows come from the newest generation, closed ones from every generation up to it. Both are partition
    filters, so closed versions are neither rewritten by a load nor read for one. With ``since`` come only closed rows
    of years not before it: enough for what is valid on that day or later.
    """
    number = latest(spark, table) if number is None else number
    if number == 0:
        return spark.createDataFrame([], schema)
    wide = T.StructType([*schema.fields, T.StructField(GENERATION, T.IntegerType()), T.StructField(END_YEAR, T.IntegerType())])
    g = F.col(GENERATION)
    keep = (g == number) | ((g < number) & ~F.col(current))
    if since is not None:
        keep = keep & (F.col(current) | (F.col(END_YEAR) >= since.year))
    return spark.read.schema(wide).parquet(table).where(keep).select(*schema.fieldNames())
