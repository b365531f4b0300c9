"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. The stages
with Python tasks bound the bytes that go to them at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airq.llm import language, linededup, neardup, packing, secrets
from airq.session import bound_batches
from airq.sources.staging import stage


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in a known language."""
    bound_batches(spark)
    return language.keep_known(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document, or an earlier place, has."""
    bound_batches(spark)
    return linededup.keep_new(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    bound_batches(spark)
    return neardup.keep_first(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    return secrets.redact(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids, placed in sequences of at most 2048 tokens."""
    bound_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language", languages), ("line_dedup", lines), ("near_dedup", near_duplicates), ("secrets", mask_secrets), ("packing", sequences),
]

#: Sketches, a fitted filter and byte-pair merges are not expressible in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
