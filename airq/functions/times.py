"""Date and time helpers.

Instants are read in UTC: the session time zone is expected to be UTC, or the
columns to be time-zone free. Local clocks come from an explicit ``tz``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airq.functions.aggregates import col


def local_time(ts: str | Column, tz: str = "UTC") -> Column:
    """Wall-clock time of a UTC instant in ``tz``."""
    ts = col(ts)
    return ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)


def local_date(ts: str | Column, tz: str = "UTC") -> Column:
    return F.to_date(local_time(ts, tz))


def local_hour(ts: str | Column, tz: str = "UTC") -> Column:
    return F.hour(local_time(ts, tz))


def floor_hour(ts: str | Column) -> Column:
    """Start of the hour, in the type of ``ts`` (``date_trunc`` changes it)."""
    ts = col(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))


def hour_between(ts: str | Column, first: int, last: int, tz: str = "UTC") -> Column:
    """Hour-of-day band with both ends included."""
    return local_hour(ts, tz).between(first, last)


def is_weekday(date: str | Column) -> Column:
    return ~F.dayofweek(col(date)).isin(1, 7)


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since 1970 with the fraction kept."""
    return F.unix_micros(col(ts).cast("timestamp")) / F.lit(1e6)


def season(ts: str | Column) -> Column:
    # Names and months of the seasons.
    month = F.month(col(ts))
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .when(month.isin(9, 10, 11), "Autumn")
    )


def utc_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def month_start(date: str | Column) -> Column:
    return F.trunc(col(date), "month")


def next_month(date: str | Column) -> Column:
    return F.add_months(month_start(date), 1)
