"""Stacking tables whose columns differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_aligned(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, by column name; missing columns become NULL."""
    if not tables:
        raise ValueError("no tables to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
