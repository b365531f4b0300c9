"""Reading tables: Parquet folders, JDBC views and typed CSV files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airq.functions.aggregates import nan_to_null
from airq.operators.align import union_aligned


def read_table(spark: SparkSession, table: str, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A whole table: a Parquet path, or a view of the database ``jdbc`` points to.

    For a large view pass ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` along, so that the read is split.
    """
    if jdbc is None:
        return spark.read.parquet(table)
    return spark.read.format("jdbc").options(**jdbc).option("dbtable", table).load()


def read_columns(
    spark: SparkSession, table: str, columns: Sequence[str], as_text: Sequence[str] = (), jdbc: Mapping[str, str] | None = None
) -> DataFrame:
    """Chosen columns of a table, some of them cast to text."""
    df = read_table(spark, table, jdbc)
    return df.select(*[F.col(c).cast("string").alias(c) if c in as_text else F.col(c) for c in columns])


def _find_column(headers: Sequence[str], name: str) -> str:
    """Header called ``name``, also when ``name`` has dots for special characters."""
    for header in headers:
        if header == name or re.sub("[^A-Za-z0-9._]", ".", header) == name:
            return header
    raise ValueError(f"no column {name!r} among {list(headers)}")


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, tuple[str, str]],
    pattern: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Typed columns of CSV files with a header line.

    ``columns`` maps each new name to its name in the file and its type. The
    files of a folder must agree on their header; ``pattern`` and ``recursive``
    choose among them. ``NA``, ``NaN``, blanks and unreadable values are missing.
    """
    reader = spark.read.options(header=True, nullValue="NA", enforceSchema=False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.csv(path)

    def typed(name: str, kind: str):
        text = df[f"`{_find_column(df.columns, name)}`"]
        return F.when(F.trim(text) != "", text).try_cast(kind)

    return nan_to_null(df.select(*[typed(name, kind).alias(new) for new, (name, kind) in columns.items()]))


def read_stacked(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several Parquet tables stacked by name; missing columns become NULL."""
    return union_aligned(*[spark.read.parquet(p) for p in paths])
