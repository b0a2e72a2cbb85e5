"""Intermediate tables in the folder all executors share, so that a lost executor costs no recompute."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


_local_folders: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="snapstrata-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own under the application's; the application's can be removed when it is done."""
    return f"{shared_folder(spark)}/snapstrata/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "etapa", session: SparkSession | None = None) -> DataFrame:
    """Writes the frame once and reads it back, into another session of the application if one is given.

    Used where a result feeds several others. Unlike a cache it survives executors; unlike a
    checkpoint it is columnar, so readers prune columns and filters, and Spark knows its size
    when it chooses between a broadcast and a shuffle.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return (session or spark).read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Intermediates stored inside are removed at the end; nothing that outlives it may read them."""
    paths = _written.setdefault(spark.sparkContext.applicationId, [])
    before = len(paths)
    try:
        yield
    finally:
        for path in paths[before:]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del paths[before:]
