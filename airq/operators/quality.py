"""Which device-days are complete, plausible and occupied.

A rule about a device-day is an aggregate condition, for a group or for a
window. Several rules are decided
in one aggregation (`days_where`), which merges before the shuffle and only
needs the rule's columns; the readings are then reduced by one semi join.
Where days are bounded and a window over the day follows anyhow, the rules are
decided in its exchange, so the readings are read and moved once.
Readings have a device and a time: rows without either belong to no day.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from airq.functions.aggregates import any_true, missing_ratio, n_rows, over, strict, strict_where
from airq.functions.times import hour_between
from airq.operators.groups import with_row_windows

DAY = ("Date", "device_id")


@dataclass(frozen=True)
class Completeness:
    """Rows a unit needs: more than ``rows``, or at least ``rows``."""

    rows: int
    at_least: bool = False


# Row counts that stand for 75 % of a unit.
SCHOOL_DAY_MINUTES = Completeness(315)
SCHOOL_DAY_QUARTERS = Completeness(21, at_least=True)
SCHOOL_DAY_HOURS = Completeness(5)
FULL_DAY_MINUTES = Completeness(1080)
FULL_DAY_HOURS = Completeness(18, at_least=True)

# Daily maxima above which a day is not believed.
EXTREMES = {"rco2": 5000, "pm02": 1000, "atmp": 50}


@dataclass(frozen=True)
class Occupancy:
    """Signs of an occupied room between two hours of the day."""

    rows: int = 315
    mean_co2: float = 480
    first_hour: int = 9
    last_hour: int = 15
    skip_missing: bool = False


OCCUPIED_MINUTES = Occupancy()
OCCUPIED_QUARTERS = Occupancy(rows=21, skip_missing=True)


def complete(rule: Completeness, window: WindowSpec | None = None) -> Column:
    return n_rows(window) >= rule.rows if rule.at_least else n_rows(window) > rule.rows


def plausible(limits: Mapping[str, float] = EXTREMES, window: WindowSpec | None = None) -> Column:
    """False when a strict maximum exceeds its limit; unknown is plausible."""
    extreme = reduce(or_, [strict(F.max, c, window) > limit for c, limit in limits.items()])
    return ~F.coalesce(extreme, F.lit(False))


def occupied(rule: Occupancy = OCCUPIED_MINUTES, tz: str = "UTC", window: WindowSpec | None = None) -> Column:
    inside = hour_between("DateTime", rule.first_hour, rule.last_hour, tz)
    value = F.when(inside, F.col("rco2"))
    mean = over(F.avg(value), window) if rule.skip_missing else strict_where(F.avg, "rco2", inside, window)
    return (over(F.count_if(inside), window) > rule.rows) & F.coalesce(mean > rule.mean_co2, F.lit(False))


def mostly_present(c: str, max_missing: float = 0.25) -> Column:
    return missing_ratio(c) <= max_missing


def days_where(df: DataFrame, *conditions: Column, keys: Sequence[str] = DAY) -> DataFrame:
    """Units for which all aggregate conditions hold, decided in one pass."""
    return df.groupBy(*keys).agg(reduce(and_, conditions).alias("_keep")).where("_keep").select(*keys)


def keep_days(df: DataFrame, days: DataFrame, keys: Sequence[str] = DAY) -> DataFrame:
    return df.join(days, list(keys), "left_semi")


def drop_days(df: DataFrame, days: DataFrame, keys: Sequence[str] = DAY) -> DataFrame:
    return df.join(days, list(keys), "left_anti")


def keep_where(df: DataFrame, *conditions: Column, keys: Sequence[str] = DAY) -> DataFrame:
    """Rows of the units for which all aggregate conditions hold."""
    return keep_days(df, days_where(df, *conditions, keys=keys), keys)


def with_co2_gradient(
    df: DataFrame,
    k: int = 5,
    reach: int = 7,
    order: Sequence[str] = ("DateTime",),
    **limits,
) -> DataFrame:
    """Add ``co2_gradient``: change of the k-row mean from ``reach`` rows back to ``reach`` rows on.

    The mean ends at its row and needs k present values.
    """
    steps = [
        {"_smooth": lambda w: F.when(
            F.count("rco2").over(w.rowsBetween(1 - k, 0)) == k, F.avg("rco2").over(w.rowsBetween(1 - k, 0)))},
        {"co2_gradient": lambda w: F.lead("_smooth", reach).over(w) - F.lag("_smooth", reach).over(w)},
    ]
    out = with_row_windows(df, DAY, order, steps, before=reach + k - 1, after=reach, **limits)
    return out.drop("_smooth")


def gradient_days(
    df: DataFrame, threshold: float = 100, first_hour: int = 9, last_hour: int = 15, tz: str = "UTC", **window
) -> DataFrame:
    """Days on which CO2 rises by more than ``threshold`` in the hour band."""
    graded = with_co2_gradient(df.select(*DAY, *window.get("order", ("DateTime",)), "rco2"), **window)
    inside = hour_between("DateTime", first_hour, last_hour, tz)
    return days_where(graded, any_true(inside & (F.col("co2_gradient") > threshold)))


def keep_gradient_days(
    df: DataFrame, threshold: float = 100, first_hour: int = 9, last_hour: int = 15, tz: str = "UTC", bounded: bool = False, **window
) -> DataFrame:
    """Readings of the days that `gradient_days` finds.

    Bounded days are judged where the gradient window has put them already, so
    the readings move once; otherwise the days are listed first and joined.
    """
    if not bounded:
        return keep_days(df, gradient_days(df, threshold, first_hour, last_hour, tz, **window))
    graded = with_co2_gradient(df, bounded=True, **window)
    rises = hour_between("DateTime", first_hour, last_hour, tz) & (F.col("co2_gradient") > threshold)
    judged = graded.withColumn("_rising", any_true(rises, W.partitionBy(*DAY)))
    return judged.where("_rising").select(*df.columns)


def step_days(
    df: DataFrame,
    threshold: float = 200,
    rising: bool = False,
    first_hour: int = 9,
    last_hour: int = 15,
    tz: str = "UTC",
    order: Sequence[str] = ("DateTime",),
    **limits,
) -> DataFrame:
    """Days with a CO2 step between successive readings of a device.

    The default finds falls (previous minus current); the series of a device
    runs on over midnight: before the first reading of a day comes the last one
    of the device's previous day with readings. It is carried in a table of one
    row per device-day, so no window holds a device's whole life.
    """
    step = (lambda old, new: new - old) if rising else (lambda old, new: old - new)
    change = {"_step": lambda w: step(F.lag("rco2", 1).over(w), F.col("rco2"))}
    stepped = with_row_windows(df.select(*DAY, *order, "rco2"), DAY, order, [change], before=1, after=0, **limits)
    inside = hour_between("DateTime", first_hour, last_hour, tz)
    place = F.struct(*order)
    days = stepped.groupBy(*DAY).agg(
        any_true(inside & (F.col("_step") > threshold)).alias("_found"),
        F.min_by(F.struct("rco2", inside.alias("inside")), place).alias("_first"), F.max_by(F.struct("rco2"), place).alias("_last"),
    )
    before = F.lag("_last", 1).over(W.partitionBy("device_id").orderBy("Date"))
    at_first = F.col("_first.inside") & (step(F.col("_before.rco2"), F.col("_first.rco2")) > threshold)
    days = days.withColumn("_before", before)
    return days.where(F.col("_found") | F.coalesce(at_first, F.lit(False))).select(*DAY)


def clean_co2_minutes(
    df: DataFrame,
    rule: Occupancy = OCCUPIED_MINUTES,
    threshold: float = 100,
    tz: str = "UTC",
    also: Sequence[Callable[[WindowSpec | None], Column]] = (),
    bounded: bool = False,
    order: Sequence[str] = ("DateTime",),
    **window,
) -> DataFrame:
    """Occupied days that also show a CO2 gradient (and meet the rules of ``also``, given for a group or a window).

    Bounded days are judged by all rules where the gradient window has put them.
    """
    rules = [*also, lambda w: occupied(rule, tz, w)]
    if bounded:
        # The order of the gradient's window, so that the day is sorted once.
        day = W.partitionBy(*DAY).orderBy(*order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        placed = df.where(reduce(and_, [F.col(c).isNotNull() for c in DAY]))
        kept = placed.withColumn("_keep", reduce(and_, [r(day) for r in rules])).where("_keep").drop("_keep")
    else:
        kept = keep_where(df, *[r(None) for r in rules])
    return keep_gradient_days(kept, threshold, rule.first_hour, rule.last_hour, tz, bounded=bounded, order=order, **window)


def clean_co2_quarters(
    df: DataFrame,
    rule: Occupancy = OCCUPIED_QUARTERS,
    threshold: float = 200,
    tz: str = "UTC",
    **window,
) -> DataFrame:
    """The same for 15-minute series, with a step instead of a gradient."""
    kept = keep_where(df, occupied(rule, tz))
    return keep_days(kept, step_days(kept, threshold, first_hour=rule.first_hour, last_hour=rule.last_hour, tz=tz, **window))
