"""Minute series at the full-scale thresholds, against a row-by-row calculation."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airq.functions.air import MEASURES
from airq.plans import reports
from airq.plans.indoor import indoor_minutes, school_hour_minutes, with_day
from airq.sources import staging

DAYS = 3


@pytest.fixture(scope="module")
def dense(spark):
    """12 devices, three days from a Friday on, one row per minute with some gaps."""
    minutes = spark.range(12 * DAYS * 1440).select(
        F.floor(F.col("id") / (DAYS * 1440)).cast("int").alias("device"), (F.col("id") % (DAYS * 1440)).alias("m"))
    day, minute, kind = F.floor(F.col("m") / 1440), F.col("m") % 1440, F.col("device") % 6
    ramp = F.greatest(F.lit(0), F.least(minute - 540, F.lit(120)))
    noise = F.pmod(F.hash("device", "m"), F.lit(40))
    co2 = 420 + F.when(kind == 2, ramp * 2).otherwise(ramp * 8) + noise / 2
    co2 = F.when((kind == 3) & (minute == 100) & (day == 1), 5001).otherwise(co2)
    rows = minutes.where(~((kind == 1) & (minute >= 1080)) & ~((kind == 0) & (minute % 10 == 3)))
    return rows.select(
        (F.lit("2024-03-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m").cast("int"))).alias("DateTime"),
        F.concat(F.lit("dev"), F.col("device").cast("string")).alias("device_id"),
        *[(noise * (i + 1) / 10).cast("double").alias(c) if c != "rco2" else
          F.when((kind == 4) & (minute == 600) & (day == 0), None).otherwise(co2.cast("double")).alias("rco2") for i, c in enumerate(MEASURES)],
    ).cache()


def clean_by_hand(pdf):
    kept = []
    for _, g in pdf.sort_values("DateTime").groupby(["device_id", "Date"]):
        if len(g) <= 1080:
            continue
        tops = [g.rco2.max(skipna=False) > 5000, g.pm02.max(skipna=False) > 1000, g.atmp.max(skipna=False) > 50]
        if any(tops):
            continue
        inside = g.DateTime.dt.hour.between(9, 15)
        if inside.sum() <= 315 or not g.rco2[inside].mean(skipna=False) > 480:
            continue
        smooth = g.rco2.rolling(5).mean()
        gradient = smooth.shift(-7) - smooth.shift(7)
        if (gradient[inside] > 100).any():
            kept.append(g)
    return pd.concat(kept)


def test_cleaning_equals_calculation_by_hand(dense):
    expected = clean_by_hand(with_day(dense).toPandas())
    got = indoor_minutes(dense).toPandas()
    days = lambda p: set(zip(p.device_id, p.Date))
    assert days(got) == days(expected) and len(got) == len(expected)
    everything = {(f"dev{i}", dt.date(2024, 3, 1 + d)) for i in range(12) for d in range(DAYS)}
    assert 0 < len(days(got)) < len(everything)


def test_row_window_equals_ungrouped_calculation(dense):
    """Windows by device-day match one window over the whole ordered table."""
    got = set(map(tuple, indoor_minutes(dense).select("device_id", "Date").distinct().collect()))
    pdf = with_day(dense).toPandas().sort_values(["device_id", "DateTime"]).reset_index(drop=True)
    size = pdf.groupby(["device_id", "Date"]).rco2.transform("size")
    pdf = pdf[size > 1080].reset_index(drop=True)
    smooth = pdf.rco2.rolling(5).mean()
    gradient = smooth.shift(-7) - smooth.shift(7)
    inside = pdf.DateTime.dt.hour.between(9, 15)
    rising = set(zip(pdf.device_id[inside & (gradient > 100)], pdf.Date[inside & (gradient > 100)]))
    assert got <= rising


def test_month_tables_at_full_scale_rules(spark, dense):
    sites = spark.createDataFrame(
        [(f"dev{i}", i // 2, f"S{i // 2}", 51.0 + i // 2, -1.0 if i != 6 else None, 1) for i in range(12)],
        "device_id string, SchoolId_short int, SchoolId_long string, SchoolLatitude double, SchoolLongitude double, SchoolType int")
    terms = spark.createDataFrame([("t", dt.date(2024, 1, 1), dt.date(2024, 3, 28))], "term_name string, start_date date, end_date date")
    holidays = spark.createDataFrame([], "date date")
    hours = [dt.datetime(2024, 3, 1, h) for h in range(24)]
    outdoor = spark.createDataFrame(
        [(h.date(), h, c, lat, -1.2, float(i)) for i, h in enumerate(hours) for c, lat in (("A", 51.5), ("B", 56.0)) if (c, h.hour) != ("A", 12)],
        "Date date, DateTime timestamp_ntz, code string, latitude double, longitude double, pm2_5 double")
    dims = reports.Dimensions(sites.select("device_id"), sites, sites, terms, holidays)
    out = reports.month_tables(dense, outdoor, dims)
    assert len(out) == 11
    clean = clean_by_hand(with_day(dense).toPandas())
    hourly = out["indoor_hourly_24"].toPandas()
    by_hand = clean.groupby(["device_id", clean.DateTime.dt.floor("h")]).rco2.mean()
    assert len(hourly) == len(by_hand)
    assert np.allclose(hourly.sort_values(["device_id", "DateTime"]).rco2, by_hand)
    daily = out["indoor_daily_24"].toPandas().sort_values(["device_id", "Date"])
    assert np.allclose(daily.pm02_q75, clean.groupby(["device_id", "Date"]).pm02.quantile(0.75))
    # Saturday and Sunday are no school days.
    school = out["indoor_hourly_school"].toPandas()
    assert set(school.Date) == {dt.date(2024, 3, 1)} and set(school.DateTime.dt.hour) == set(range(9, 16))
    rate = out["ventilation"].toPandas()
    assert len(rate) == len(daily) and (rate.pp_ventilation > 0).all()
    pairs = out["in_out_24"].toPandas()
    # Only the first day has stations; dev6 has no position; two schools are nearer to A's gap at noon.
    assert set(pairs.Date) == {dt.date(2024, 3, 1)} and "dev6" not in set(pairs.device_id)
    assert pairs[pairs.closest_station == "A"].groupby("device_id").pm2_5.apply(lambda s: s.isna().sum()).eq(1).all()
    assert not pairs.duplicated(["device_id", "DateTime"]).any()
    assert set(out["ensemble_daily_school"].columns) >= {"Date", "CO2", "rco2", "rco2_median", "pp_ventilation"}


def test_school_minutes_use_whole_day_counts(spark, dense):
    terms = spark.createDataFrame([("t", dt.date(2024, 1, 1), dt.date(2024, 3, 28))], "term_name string, start_date date, end_date date")
    holidays = spark.createDataFrame([], "date date")
    few = with_day(dense.where((F.col("device_id") == "dev0") & F.hour("DateTime").between(0, 5)))
    assert school_hour_minutes(few, terms, holidays).count() == 0
    assert school_hour_minutes(with_day(dense.where("device_id = 'dev0'")), terms, holidays).count() == 7 * 54


def test_monthly_run_keeps_the_last_day(spark, dense, tmp_path):
    series_of = lambda a, b: dense.where((F.col("DateTime") >= F.lit(str(a)).cast("timestamp_ntz")) & (F.col("DateTime") < F.lit(str(b)).cast("timestamp_ntz")))
    sites = spark.createDataFrame([("dev0", 1, "S", 51.0, -1.0, 1)], "device_id string, SchoolId_short int, SchoolId_long string, SchoolLatitude double, SchoolLongitude double, SchoolType int")
    terms = spark.createDataFrame([("t", dt.date(2024, 1, 1), dt.date(2024, 3, 28))], "term_name string, start_date date, end_date date")
    dims = reports.Dimensions(None, sites, sites, terms, spark.createDataFrame([], "date date"))
    outdoor = spark.createDataFrame([(dt.date(2024, 3, 1), dt.datetime(2024, 3, 1), "A", 51.0, -1.0, 1.0)], "Date date, DateTime timestamp_ntz, code string, latitude double, longitude double, pm2_5 double")
    shifted = dense.withColumn("DateTime", F.col("DateTime") + F.expr("interval 28 days"))
    moved = lambda a, b: shifted.where((F.col("DateTime") >= F.lit(str(a)).cast("timestamp_ntz")) & (F.col("DateTime") < F.lit(str(b)).cast("timestamp_ntz")))
    root, before = str(tmp_path / "months"), len(staging._staged)
    assert reports.run_months(spark, root, [dt.date(2024, 3, 1)], moved, outdoor, dims) == [dt.date(2024, 3, 1)]
    assert reports.run_months(spark, root, [dt.date(2024, 3, 1)], moved, outdoor, dims) == []
    assert len(staging._staged) == before
    back = reports.load_months(spark, root, ["indoor_daily_24"])["indoor_daily_24"]
    assert back.agg(F.max("Date")).first()[0] == dt.date(2024, 3, 31)
    assert series_of(dt.date(2024, 3, 1), dt.date(2024, 4, 1)).count() == dense.count()
