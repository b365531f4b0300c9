"""Reading time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.functions.aggregates import nan_to_null, not_in
from airq.functions.air import MEASURES
from airq.operators.rollup import window_means

# Kinds of stations that do not stand for background air.
EXCLUDED_SITE_TYPES = ("Urban Traffic", "Urban Industrial", "Suburban Industrial")


def in_range(df: DataFrame, start, end, time: str = "ts", day: str | None = None, devices: Sequence | None = None) -> DataFrame:
    """Readings with ``start <= time < end``, optionally of some devices.

    ``day`` names a date column the files are partitioned by; the range then
    also prunes partitions.
    """
    kind = dict(df.dtypes)[time]
    first, stop = F.lit(start).cast(kind), F.lit(end).cast(kind)
    df = df.where((F.col(time) >= first) & (F.col(time) < stop))
    if day is not None:
        df = df.where(F.col(day).between(F.to_date(first), F.to_date(stop)))
    return df if devices is None else df.where(F.col("device_id").isin(*devices))


def read_series(
    long: DataFrame, start, end, every: str = "1 minute", fields: Sequence[str] = MEASURES, **range_options
) -> DataFrame:
    """Wide series of tumbling-window means in ``[start, end)``; NaN readings are missing."""
    return window_means(nan_to_null(in_range(long, start, end, **range_options)), every, fields)


def background_stations(meta: DataFrame, excluded: Sequence = EXCLUDED_SITE_TYPES) -> DataFrame:
    """Station metadata without the excluded kinds; an unknown kind stays."""
    return meta.where(not_in("site_type", list(excluded)))


def station_readings(hourly: DataFrame, stations: DataFrame, years: Sequence[int] | None = None, time: str = "date") -> DataFrame:
    """Readings of the given stations; whole years as time ranges, which reach the scan. NaN is missing."""
    if years is not None:
        kind = dict(hourly.dtypes)[time]

        def moment(year: int) -> Column:
            return F.lit(f"{year:04d}-01-01 00:00:00").cast(kind)

        low, high = min(years), max(years)
        hourly = hourly.where((F.col(time) >= moment(low)) & (F.col(time) < moment(high + 1)))
        if len(set(years)) < high - low + 1:
            hourly = hourly.where(F.year(time).isin(*years))
    return nan_to_null(hourly.join(stations.select("code"), "code", "left_semi"))
