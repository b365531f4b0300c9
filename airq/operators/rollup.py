"""From readings to hours, days and ensembles."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airq.functions.air import MEASURES
from airq.functions.text import date_device
from airq.functions.times import floor_hour
from airq.operators.groups import group_quantiles
from airq.operators.quality import DAY

QUARTILES = (0.5, 0.25, 0.75)


def window_means(long: DataFrame, every: str = "1 minute", fields: Sequence[str] = MEASURES) -> DataFrame:
    """Tumbling-window mean per device and field, one column per field.

    Long input ``(ts, device_id, field, value)``; windows without readings do
    not appear. Mean and pivot are one aggregation, so there is one shuffle.
    """
    value = [F.avg(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    grouped = long.where(F.col("field").isin(*fields)).groupBy(F.window("ts", every).alias("_window"), "device_id")
    return grouped.agg(*value).select(F.col("_window.start").alias("DateTime"), "device_id", *fields)


def hourly_means(df: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Mean per hour and device, with the day columns the input has.

    The day is constant within the group. Its text form is made again from the
    result: a text among the aggregates would have all readings sorted.
    """
    day = [F.first("Date").alias("Date")] if "Date" in df.columns else []
    hours = df.groupBy(floor_hour("DateTime").alias("DateTime"), "device_id").agg(*[F.avg(m).alias(m) for m in measures], *day)
    if "DateDevice" not in df.columns:
        return hours
    return hours.select("DateTime", "device_id", *measures, date_device().alias("DateDevice"), "Date")


def four_statistics(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] = MEASURES,
    bounded: bool = False,
) -> DataFrame:
    """Mean, median and quartiles of each measure per group."""
    q = group_quantiles(df, keys, measures, QUARTILES, bounded)
    columns = []
    for m in measures:
        columns += [
            F.col(f"{m}_mean"),
            F.col(f"{m}_q")[0].alias(f"{m}_median"),
            F.col(f"{m}_q")[1].alias(f"{m}_q25"),
            F.col(f"{m}_q")[2].alias(f"{m}_q75"),
        ]
    return q.select(*keys, *columns)


def daily_summary(df: DataFrame, measures: Sequence[str] = MEASURES, **limits) -> DataFrame:
    return four_statistics(df, DAY, measures, **limits)


def strip_mean_suffix(df: DataFrame) -> DataFrame:
    return df.toDF(*[re.sub("_mean$", "", c) for c in df.columns])


def ensemble(df: DataFrame, key: str = "DateTime", measures: Sequence[str] = MEASURES, **limits) -> DataFrame:
    """Four statistics across all devices that report at a time."""
    return four_statistics(df, [key], measures, **limits)


def ensemble_of_daily_means(daily: DataFrame, measures: Sequence[str] = MEASURES, **limits) -> DataFrame:
    means = daily.select("Date", *[F.col(f"{m}_mean").alias(m) for m in measures])
    return ensemble(means, "Date", measures, **limits)


def mean_of_all(df: DataFrame, key: str) -> DataFrame:
    """Mean of every numeric column per key."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name != key]
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in numeric])


def network_hourly(df: DataFrame, indoor: str = "pm02", outdoor: str = "pm2_5") -> DataFrame:
    """Mean indoor and outdoor value of each hour over all sites."""
    return df.groupBy(floor_hour("DateTime").alias("date")).agg(
        F.avg(indoor).alias("indoor"), F.avg(outdoor).alias("outdoor")
    )
