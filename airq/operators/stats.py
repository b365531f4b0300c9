"""Summaries and regressions behind the figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.functions.aggregates import is_finite, n_distinct
from airq.functions.text import distance_label, regression_label
from airq.functions.times import season
from airq.operators.groups import first_per_key, group_quantiles
from airq.sources.staging import stage


def site_pairs(in_out: DataFrame, station: str = "site") -> DataFrame:
    """One row per school and station it was paired with, both located.

    The earliest reading of the pair stands for it.
    """
    row = in_out.select(
        "SchoolId_short", F.col(station).alias("station"),
        F.col("SchoolLongitude").alias("school_lon"), F.col("SchoolLatitude").alias("school_lat"),
        F.col("longitude").alias("station_lon"), F.col("latitude").alias("station_lat"),
        F.col("km_distance_to_station").alias("distance_km"), "DateTime",
    )
    # Readings shrink to distinct pairings by hashing; only those few are ranked.
    pairings = row.groupBy(*[c for c in row.columns if c != "DateTime"]).agg(F.min("DateTime").alias("DateTime"))
    first = first_per_key(pairings, ["SchoolId_short", "station"], [F.col("DateTime")]).drop("DateTime")
    return first.where(F.col("school_lat").isNotNull() & F.col("station_lat").isNotNull())


def distance_summary(pairs: DataFrame) -> DataFrame:
    """One row: schools, mean, median, smallest and largest distance, label.

    The pairs are read several times and are costly to make, so they are staged.
    """
    pairs = stage(pairs.select("SchoolId_short", "distance_km"), "pairs")
    plain = pairs.agg(
        n_distinct("SchoolId_short").cast("bigint").alias("n_schools"), F.avg("distance_km").alias("mean_km"),
        F.min("distance_km").alias("min_km"), F.max("distance_km").alias("max_km"),
    )
    middle = group_quantiles(pairs, [], ["distance_km"], [0.5]).select(F.col("distance_km_q")[0])
    out = plain.withColumn("median_km", middle.scalar())
    label = distance_label("n_schools", "mean_km", "median_km", "min_km", "max_km")
    return out.select("n_schools", "mean_km", "median_km", "min_km", "max_km", label.alias("label"))


def in_year(df: DataFrame, year: int, time: str = "DateTime") -> DataFrame:
    """Rows of a calendar year as a half-open range, which reaches the scan."""
    kind = dict(df.dtypes)[time]
    first, stop = (F.lit(f"{y:04d}-01-01 00:00:00").cast(kind) for y in (year, year + 1))
    return df.where((F.col(time) >= first) & (F.col(time) < stop))


def annual_means(in_out: DataFrame, year: int, site: str = "SchoolId_short", indoor: str = "pm02", outdoor: str = "pm2_5") -> DataFrame:
    """Mean indoor and outdoor value per site in a year, where both exist."""
    means = in_year(in_out, year).groupBy(site).agg(
        F.avg(indoor).alias("indoor"), F.avg(outdoor).alias("outdoor"))
    return means.where(F.col("indoor").isNotNull() & F.col("outdoor").isNotNull())


def annual_ratio(in_out: DataFrame, year: int, **names) -> DataFrame:
    means = annual_means(in_out, year, **names)
    usable = means.where(is_finite("indoor") & is_finite("outdoor") & (F.col("outdoor") > 0))
    return usable.withColumn("io_ratio", F.try_divide("indoor", "outdoor"))


def seasonal_ratio(in_out: DataFrame, year: int, site: str = "SchoolId_short", indoor: str = "pm02", outdoor: str = "pm2_5") -> DataFrame:
    """Mean values and their ratio per site and season of a calendar year."""
    means = in_year(in_out, year).groupBy(site, season("DateTime").alias("Season")).agg(
        F.avg(indoor).alias("indoor"), F.avg(outdoor).alias("outdoor"))
    ratio = means.withColumn("IO_ratio", F.try_divide("indoor", "outdoor"))
    return ratio.where(is_finite("IO_ratio"))


def _complete(x: str, y: str) -> Column:
    return F.col(x).isNotNull() & F.col(y).isNotNull()


def _sums(x: str, y: str) -> list[Column]:
    return [
        F.regr_count(y, x).alias("n"), F.regr_avgx(y, x).alias("_ax"), F.regr_avgy(y, x).alias("_ay"),
        F.regr_sxx(y, x).alias("_xx"), F.regr_syy(y, x).alias("_yy"), F.regr_sxy(y, x).alias("_xy"),
    ]


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation over complete pairs, NULL where a side does not vary."""
    return linear_fit(df, x, y).select("r")


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least squares ``y ~ x`` per group: coefficients, fit, slope error, size.

    All terms are mergeable sums, so a large group costs no more than a small
    one. Where x does not vary there is no slope; below three rows no error.
    """
    sums = df.where(_complete(x, y)).groupBy(*by).agg(*_sums(x, y))
    xx, yy, xy = F.col("_xx"), F.col("_yy"), F.col("_xy")
    spare = F.when(F.col("n") > 2, F.col("n") - 2)
    rest = F.greatest(yy - F.try_divide(xy * xy, xx), F.lit(0.0))
    fit = sums.withColumns({
        "r": F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy)),
        "r2": F.try_divide(xy * xy, xx * yy),
        "slope": F.try_divide(xy, xx),
        "slope_se": F.sqrt(F.try_divide(F.try_divide(rest, spare), xx)),
    })
    fit = fit.withColumn("intercept", F.col("_ay") - F.col("slope") * F.col("_ax"))
    return fit.select(*by, "n", "r", "r2", "intercept", "slope", "slope_se")


def with_regression_label(fit: DataFrame) -> DataFrame:
    return fit.withColumn("label", regression_label("n", "r", "r2", "intercept", "slope"))


def temporal_profile(
    df: DataFrame, series: Sequence[str] = ("indoor", "outdoor"), time: str = "date", normalise: bool = True
) -> DataFrame:
    """Median of each series by weekday and hour, hour, weekday, and month.

    One pass: every row counts towards its four groups. With ``normalise`` the
    medians are divided by the overall mean of their series. The input is small
    (a row per hour) but may be costly to make, so it is staged.
    """
    df = stage(df.select(time, *series), "profile")
    none = F.lit(None).cast("int")
    weekday, hour, month = F.dayofweek(time), F.hour(time), F.month(time)

    def group(name: str, d: Column, h: Column, m: Column) -> Column:
        return F.struct(F.lit(name).alias("profile"), d.alias("weekday"), h.alias("hour"), m.alias("month"))

    groups = F.array(
        group("weekday_hour", weekday, hour, none), group("hour", none, hour, none),
        group("weekday", weekday, none, none), group("month", none, none, month),
    )
    keys = ["profile", "weekday", "hour", "month"]
    long = df.withColumn("_g", F.explode(groups)).select("_g.*", *series)
    medians = group_quantiles(long, keys, series, [0.5])

    def value(s: str) -> Column:
        median = F.col(f"{s}_q")[0]
        return F.try_divide(median, df.select(F.avg(s)).scalar()) if normalise else median

    return medians.select(*keys, *[value(s).alias(s) for s in series])
