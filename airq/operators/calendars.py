"""School days: weekdays within a term that are no holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.functions.times import hour_between, is_weekday


def term_days(terms: DataFrame, grace_days: int = 1) -> DataFrame:
    """One row per day of any term; a term lasts ``grace_days`` past its end."""
    days = F.sequence(F.col("start_date"), F.date_add("end_date", grace_days))
    return terms.where(F.col("end_date") >= F.date_sub("start_date", grace_days)).select(F.explode(days).alias("Date")).distinct()


def open_days(terms: DataFrame, holidays: DataFrame, grace_days: int = 1) -> DataFrame:
    closed = holidays.select(F.col("date").alias("Date"))
    return term_days(terms, grace_days).where(is_weekday("Date")).join(closed, "Date", "left_anti")


def school_days(
    df: DataFrame,
    terms: DataFrame,
    holidays: DataFrame,
    first_hour: int = 9,
    last_hour: int = 15,
    grace_days: int = 1,
    tz: str = "UTC",
) -> DataFrame:
    """Readings of school hours on school days.

    Terms, holidays and weekends meet in one list of dates (some hundred per
    year), so the readings see a filter and a single semi join.
    """
    inside = df.where(hour_between("DateTime", first_hour, last_hour, tz))
    return inside.join(open_days(terms, holidays, grace_days), "Date", "left_semi")
