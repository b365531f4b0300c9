"""Result tables of a month and of a whole period."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airq.operators.calendars import school_days
from airq.operators.lookup import natural_join
from airq.operators.nearest import closest_station_each_day, link_outdoor
from airq.operators.rollup import (
    daily_summary, ensemble, ensemble_of_daily_means, four_statistics, hourly_means, mean_of_all, strip_mean_suffix,
)
from airq.operators.ventilation import by_ventilation, ventilation
from airq.plans.indoor import CleaningRules, indoor_minutes, school_hour_minutes
from airq.sources.outputs import Keep, finished_months, read_months, write_months
from airq.sources.staging import stage, staged_within


@dataclass(frozen=True)
class Dimensions:
    """Tables that do not depend on the period.

    ``devices``: ids to keep. ``device_schools``: one row per ``device_id``
    with ``SchoolType`` and ``SchoolId_long``. ``device_sites``: one row per
    ``device_id`` with ``SchoolId_short, SchoolLatitude, SchoolLongitude``.
    """

    devices: DataFrame | None
    device_schools: DataFrame
    device_sites: DataFrame
    terms: DataFrame
    holidays: DataFrame


def _with_sites(hourly: DataFrame, dims: Dimensions) -> DataFrame:
    sites = dims.device_sites.select("device_id", "SchoolId_short", "SchoolLatitude", "SchoolLongitude")
    return natural_join(hourly, sites, null_safe=False)


def _daily_school_hours(hourly: DataFrame, rate: DataFrame, dims: Dimensions, rules: CleaningRules, limits: Mapping) -> DataFrame:
    inside = school_days(hourly, dims.terms, dims.holidays, tz=rules.tz)
    daily = four_statistics(inside, ["Date", "device_id", "DateDevice"], rules.measures, **limits)
    return daily.join(rate, ["Date", "device_id", "DateDevice"], "left")


def _staged(name: str, df: DataFrame) -> DataFrame:
    return stage(df, name)


def _base_tables(series: DataFrame, dims: Dimensions, rules: CleaningRules, keep: Keep) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    # Four tables and more read the clean minutes, several the hourly means:
    # both are written once instead of being computed again for each reader.
    minutes = stage(indoor_minutes(series, dims.devices, rules), "minutes")
    school = stage(school_hour_minutes(minutes, dims.terms, dims.holidays, rules), "school-minutes")
    return (
        minutes, school,
        keep("indoor_hourly_24", hourly_means(minutes, rules.measures)),
        keep("indoor_hourly_school", hourly_means(school, rules.measures)),
    )


def _in_out(hourly: DataFrame, school_hourly: DataFrame, outdoor: DataFrame, dims: Dimensions) -> dict[str, DataFrame]:
    # The school hours lie on days of the full series, so one pairing serves both.
    full = _with_sites(hourly, dims)
    closest = closest_station_each_day(full, outdoor)
    return {
        "in_out_24": link_outdoor(full, outdoor, closest),
        "in_out_school": link_outdoor(_with_sites(school_hourly, dims), outdoor, closest),
    }


def month_tables(
    series: DataFrame, outdoor: DataFrame, dims: Dimensions, rules: CleaningRules = CleaningRules(),
    vent_hours: tuple[int | None, int] = (5, 22), keep: Keep = _staged,
) -> dict[str, DataFrame]:
    """The eleven tables of one month; ``series`` and ``outdoor`` hold that month.

    Tables that others are made from go through ``keep``, which writes them and gives a reader.
    """
    limits = {"bounded": rules.one_row_per_minute}
    minutes, _, hourly, school_hourly = _base_tables(series, dims, rules, keep)
    daily = keep("indoor_daily_24", daily_summary(minutes, rules.measures, **limits))
    rate = keep("ventilation", ventilation(
        hourly, dims.device_schools, first_hour=vent_hours[0], last_hour=vent_hours[1], tz=rules.tz, bounded=True))
    school_daily = keep("indoor_daily_school", _daily_school_hours(hourly, rate, dims, rules, {"bounded": True}))
    return {
        "indoor_hourly_24": hourly,
        "indoor_hourly_school": school_hourly,
        "indoor_daily_24": daily,
        "indoor_daily_school": school_daily,
        "ventilation": rate,
        **_in_out(hourly, school_hourly, outdoor, dims),
        "ensemble_hourly_school": mean_of_all(school_hourly.drop("device_id"), "DateTime"),
        "ensemble_hourly_24": mean_of_all(hourly.drop("device_id"), "DateTime"),
        "ensemble_daily_school": mean_of_all(strip_mean_suffix(school_daily.drop("device_id")), "Date"),
        "ensemble_daily_24": mean_of_all(strip_mean_suffix(daily.drop("device_id")), "Date"),
    }


def run_months(
    spark: SparkSession,
    root: str,
    months: list[date],
    series_of: Callable[[date, date], DataFrame],
    outdoor: DataFrame,
    dims: Dimensions,
    rules: CleaningRules = CleaningRules(),
) -> list[date]:
    """Write the tables of every month that is not finished yet.

    ``series_of(start, end)`` reads ``[start, end)``; a month ends where the
    next one starts, so its last day is complete.
    """

    def make(month: date, keep: Keep) -> dict[str, DataFrame]:
        stop = date(month.year + month.month // 12, month.month % 12 + 1, 1)
        return month_tables(series_of(month, stop), cleaned.where(F.col("_month") == F.lit(month)).drop("_month"), dims, rules, keep=keep)

    finished = set(finished_months(spark, root))
    open_months = [m for m in months if m not in finished]
    if not open_months:
        return []
    with staged_within(spark):
        # Made once for all open months; a folder each, so a month opens only its own files.
        month_of = F.trunc("Date", "month")
        cleaned = stage(outdoor.withColumn("_month", month_of).where(F.col("_month").isin(*open_months)), "outdoor", by=["_month"])
        return write_months(spark, root, open_months, make)


def load_months(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    return read_months(spark, root, names)


def period_tables(
    series: DataFrame,
    outdoor: DataFrame,
    dims: Dimensions,
    single_monitor_devices: DataFrame | None = None,
    rules: CleaningRules = CleaningRules(),
    keep: Keep = _staged,
) -> dict[str, DataFrame]:
    """Tables of one period, with four-statistic ensembles and ventilation by school; ``keep`` as in `month_tables`."""
    limits = {"bounded": rules.one_row_per_minute}
    minutes, school, hourly, school_hourly = _base_tables(series, dims, rules, keep)
    daily = keep("indoor_daily_24", daily_summary(minutes, rules.measures, **limits))
    rate = stage(ventilation(
        hourly, dims.device_schools, by_school=True, only_devices=single_monitor_devices, tz=rules.tz, bounded=True), "rate")
    school_daily = keep("indoor_daily_school", _daily_school_hours(hourly, rate, dims, rules, {"bounded": True}))
    return {
        "indoor_hourly_school": school_hourly,
        "indoor_hourly_24": hourly,
        "indoor_daily_24": daily,
        "ventilation": by_ventilation(rate),
        "indoor_daily_school": school_daily,
        "ensemble_minutes_school": ensemble(school, "DateTime", rules.measures),
        "ensemble_hourly_school": ensemble(school_hourly, "DateTime", rules.measures),
        "ensemble_daily_school": ensemble_of_daily_means(school_daily, rules.measures),
        "ensemble_minutes_24": ensemble(minutes, "DateTime", rules.measures),
        "ensemble_hourly_24": ensemble(hourly, "DateTime", rules.measures),
        "ensemble_daily_24": ensemble_of_daily_means(daily, rules.measures),
        "outdoor": outdoor,
        **_in_out(hourly, school_hourly, outdoor, dims),
    }
