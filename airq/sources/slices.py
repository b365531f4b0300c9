"""Time slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def time_slices(spark: SparkSession, start: str, end: str, step: str) -> DataFrame:
    """Slices ``[slice_start, slice_end)`` of a range; the last one ends at ``end``."""
    first, stop = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    width = F.expr(f"interval {step}")
    starts = spark.range(1).select(F.explode(F.sequence(first, stop, width)).alias("slice_start"))
    return starts.where(F.col("slice_start") < stop).withColumn("slice_end", F.least(F.col("slice_start") + width, stop))


def slices_of(df: DataFrame, step: str, time: str = "ts") -> DataFrame:
    """Half-open slices that cover all times of ``df``, the last one too, from midnight of its first day."""
    span = df.agg(F.min(time).alias("low"), F.max(time).alias("high"))
    width = F.expr(f"interval {step}")
    low = F.to_date("low").cast("timestamp_ntz")
    starts = span.select(F.explode(F.sequence(low, F.col("high").cast("timestamp_ntz"), width)).alias("slice_start"))
    return starts.select("slice_start", (F.col("slice_start") + width).alias("slice_end"))
