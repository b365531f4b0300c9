"""Indoor series: from raw readings to clean minutes and their summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from airq.functions.air import MEASURES
from airq.functions.text import date_device
from airq.functions.times import local_date
from airq.functions.aggregates import nan_to_null
from airq.operators import quality as Q
from airq.operators.calendars import school_days
from airq.operators.lookup import keep_devices


@dataclass(frozen=True)
class CleaningRules:
    """Thresholds of the minute cleaning; the defaults are the full-scale ones."""

    complete_day: Q.Completeness = Q.FULL_DAY_MINUTES
    complete_school_day: Q.Completeness = Q.SCHOOL_DAY_MINUTES
    extremes: Mapping[str, float] = field(default_factory=lambda: dict(Q.EXTREMES))
    occupancy: Q.Occupancy = Q.OCCUPIED_MINUTES
    gradient: float = 100
    smooth_rows: int = 5
    reach_rows: int = 7
    measures: Sequence[str] = MEASURES
    tz: str = "UTC"
    order: Sequence[str] = ("DateTime",)
    # One row per device and minute makes a day at most 1440 rows; otherwise days are handled in chunks.
    one_row_per_minute: bool = True


def with_day(df: DataFrame, tz: str = "UTC") -> DataFrame:
    dated = df.withColumn("Date", local_date("DateTime", tz))
    return dated.withColumn("DateDevice", date_device())


def indoor_minutes(series: DataFrame, devices: DataFrame | None = None, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Minutes of complete, plausible, occupied days with a CO2 gradient.

    The first three rules judge whole days by aggregates and are decided
    together, for bounded days in the exchange of the gradient's window.
    """
    df = with_day(nan_to_null(series), rules.tz)
    if devices is not None:
        df = keep_devices(df, devices)
    return Q.clean_co2_minutes(
        df, rules.occupancy, rules.gradient, rules.tz, also=(lambda w: Q.complete(rules.complete_day, w), lambda w: Q.plausible(rules.extremes, w)),
        bounded=rules.one_row_per_minute,
        k=rules.smooth_rows, reach=rules.reach_rows, order=rules.order,
    )


def school_hour_minutes(
    minutes: DataFrame, terms: DataFrame, holidays: DataFrame, rules: CleaningRules = CleaningRules()
) -> DataFrame:
    """School-hour minutes of the days with enough rows (counted over the whole day)."""
    kept = Q.keep_where(minutes, Q.complete(rules.complete_school_day))
    return school_days(kept, terms, holidays, tz=rules.tz)
