"""Ventilation per person from the daily integral of excess CO2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.functions.aggregates import strict
from airq.functions.air import OCCUPANCY, age_group, co2_excess, generation_rate
from airq.functions.text import date_device
from airq.functions.times import epoch_seconds, hour_between
from airq.operators.groups import with_row_windows, with_running_sum
from airq.operators.quality import DAY


def with_co2_trapezoids(
    df: DataFrame, order: Sequence[str] = ("DateTime",), **limits
) -> DataFrame:
    """Add ``C_excess``, ``t_diff`` (s) and ``C_trap`` (h) within a device-day.

    The first reading of a day has no interval; gaps are bridged.
    """
    with_excess = df.withColumns({"C_excess": co2_excess("rco2"), "_t": epoch_seconds("DateTime")})
    steps = [{
        "t_diff": lambda w: F.coalesce(F.col("_t") - F.lag("_t", 1).over(w), F.lit(0.0)),
        "_earlier": lambda w: F.lag("C_excess", 1, 0.0).over(w),
    }]
    out = with_row_windows(with_excess, DAY, order, steps, before=1, after=0, **limits)
    trapezoid = (F.col("t_diff") / 3600) * (F.col("C_excess") + F.col("_earlier")) / 2
    return out.withColumn("C_trap", trapezoid).drop("_t", "_earlier")


def with_running_integral(df: DataFrame, order: Sequence[str] = ("DateTime",), **limits) -> DataFrame:
    """Add ``C_integral``, the running integral of excess CO2 in a device-day."""
    apart = {k: v for k, v in limits.items() if k != "chunk_rows"}
    return with_running_sum(with_co2_trapezoids(df, order, **limits), DAY, order, "C_trap", "C_integral", **apart)


def ventilation(
    hourly: DataFrame,
    devices: DataFrame,
    by_school: bool = False,
    only_devices: DataFrame | None = None,
    first_hour: int | None = 5,
    last_hour: int = 22,
    tz: str = "UTC",
    order: Sequence[str] = ("DateTime",),
    **limits,
) -> DataFrame:
    """Litres per second and person, and mean CO2, per device-day.

    ``devices`` has one row per ``device_id`` with ``SchoolType`` (and
    ``SchoolId_long`` if ``by_school``). A day whose integral is zero has no
    estimate. The age group depends on the device alone, so it joins the
    daily result and never the hourly rows.
    """
    df = hourly if only_devices is None else hourly.join(only_devices, "device_id", "left_semi")
    if first_hour is not None:
        df = df.where(hour_between("DateTime", first_hour, last_hour, tz))
    df = with_co2_trapezoids(df.select(*DAY, *order, "rco2"), order, **limits)
    daily = df.groupBy(*DAY).agg(
        strict(F.sum, "C_trap").alias("_integral"), strict(F.avg, "rco2").alias("CO2_mean"))
    keep = ["device_id", "SchoolType", *(["SchoolId_long"] if by_school else [])]
    daily = daily.join(devices.select(*keep), "device_id", "left")
    rate = generation_rate(age_group("SchoolType"))
    estimate = F.try_divide(F.lit(0.001 * OCCUPANCY) * rate, F.col("_integral"))
    return daily.select(
        *(["SchoolId_long"] if by_school else []), *DAY,
        estimate.alias("pp_ventilation"), "CO2_mean", date_device().alias("DateDevice"),
    )


def by_ventilation(df: DataFrame) -> DataFrame:
    """Best-ventilated days first, days without an estimate last."""
    return df.orderBy(F.desc_nulls_last("pp_ventilation"))
