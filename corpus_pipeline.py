"""A training-data pipeline: quality rules, quality classifier, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and returns a frame
that is written as Parquet and read again as the next one's documents. All but the last return the columns of
`documents`; texts that a stage cuts come with their new number of characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.llm import near_dedup, packing, quality_outliers, quality_ranking, substring_dedup
from snapstrata.llm.common import shipped, stored, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep."""
    shipped(spark)
    return quality_outliers.kept(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of label 1 by a model fitted on the labels of documents that are here."""
    shipped(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_ranking.kept(docs, quality_ranking.fitted(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each class of near-duplicates."""
    shipped(spark)
    return near_dedup.kept(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of a smaller id has."""
    shipped(spark)
    return substring_dedup.cut(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    shipped(spark)
    return packing.packed(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: Fitted models, sketches and tokens are beyond SQL; tests compare with plain computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
