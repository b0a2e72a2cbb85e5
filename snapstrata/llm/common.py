"""Shared pieces of the corpus operators: inputs, stored intermediates, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.sources.scratch import stored

__all__ = ["documents", "mapped", "mixed", "set_aside", "shipped", "stored", "texts", "vocabulary"]


_shipped: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Sends this library to the executors, once for each application: their Python need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix=f"{root.name}-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for module in sorted(root.rglob("*.py")):
            file.write(module, module.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, which every worker has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Identifier, text (null: empty) and named columns; other columns of the input may have any name."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The documents with all columns but `used` under names that nothing else has, and how to get the columns back."""
    names = docs.columns
    others = {x: f"aside_{i}" for i, x in enumerate(names) if x not in used}
    frame = docs.select(*used, *(F.col(f"`{x}`").alias(y) for x, y in others.items()))
    return frame, lambda df: df.select(*(F.col(others.get(x, x)).alias(x) for x in names))


def mapped(df: DataFrame, rows: Callable[[list, list], dict], schema: str, passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`rows(texts as bytes, batch columns)` for each Arrow batch; `passed` columns go through unchanged.

    `df` has a column `text`; `schema` lists the passed columns first, then what `rows` returns by name.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = rows(batch.column("text").cast(pa.binary()).to_pylist(), batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(x) if x in passed else pa.array(made[x]) if not isinstance(made[x], pa.Array) else made[x] for x in names], names
            )

    return df.mapInArrow(run, schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: close inputs give unrelated outputs."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
