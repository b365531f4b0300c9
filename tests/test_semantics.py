"""Missing values, thresholds and calendar edges on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airq.functions import aggregates as A
from airq.functions import text, times
from airq.functions.air import age_group, generation_rate
from airq.operators import lookup as L
from airq.operators import quality as Q
from airq.operators import rollup as R
from airq.operators import stats as S
from airq.operators.align import union_aligned
from airq.operators.calendars import school_days
from airq.operators.ventilation import by_ventilation, ventilation, with_running_integral
from airq.plans.indoor import with_day

T0 = dt.datetime(2024, 3, 4)


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def at(hour, minute=0, day=0):
    return T0 + dt.timedelta(days=day, hours=hour, minutes=minute)


def test_strict_and_lenient(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0)], "k string, v double")
    out = df.groupBy("k").agg(A.strict(F.max, "v").alias("s"), F.max("v").alias("l"), A.n_distinct("v").alias("n"))
    assert sorted(map(tuple, out.collect())) == [("a", None, 1.0, 2), ("b", 4.0, 4.0, 2)]


def test_nan_becomes_null(spark):
    df = A.nan_to_null(spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "v double, s string"))
    assert df.agg(F.avg("v"), F.count("v")).first()[:] == (1.0, 1)


def test_not_in_keeps_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert {r.k for r in df.where(A.not_in("k", ["a"])).collect()} == {"b", None}


def test_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert df.where(A.is_finite("v")).count() == 1


def test_single_valued(spark):
    rows = [("one", "x"), ("one", "x"), ("two", "x"), ("two", "y"), ("mixed", "x"), ("mixed", None), ("none", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    assert {tuple(r) for r in L.unambiguous(df, "k", "v").collect()} == {("one", "x"), ("none", None)}
    several = {r.k: r.v for r in L.unambiguous_values(df, "k", ["v"]).collect()}
    assert several == {"one": "x", "two": None, "mixed": None, "none": None}


def test_lookup_matches_missing_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    table = spark.createDataFrame([("a", "A"), (None, "missing")], "key string, label string")
    assert values(L.lookup(left, table, {"k": "key"}).na.fill("-"), "id", "label") == [(1, "A"), (2, "missing"), (3, "-")]
    assert values(L.lookup(left, table, {"k": "key"}, null_safe=False).na.fill("-"), "id", "label") == [(1, "A"), (2, "-"), (3, "-")]


@pytest.mark.parametrize("raw, formatted, cleaned, area", [
    ("sw7 2az", "SW7 2AZ", "SW7 2AZ", "SW"), ("SW72AZ", "SW7 2AZ", "SW72AZ", "SW"), ("SW7-2AZ", "SW7 2AZ", "SW72AZ", "SW"),
    ("", None, "", None), ("   ", None, "", None), (None, None, None, None), ("X1", None, "X1", None),
    ("ABCDEFGHI", None, "ABCDEFGHI", None), ("b1  1bb ", "B1 1BB", "B1 1BB", "B"), ("12345", "12345", "12345", "1"),
])
def test_postcodes(spark, raw, formatted, cleaned, area):
    df = spark.createDataFrame([(raw,)], "p string").select(
        text.format_postcode("p").alias("f"), text.clean_postcode("p").alias("c"))
    row = df.withColumn("a", text.postcode_area("f")).first()
    assert (row.f, row.c, row.a) == (formatted, cleaned, area)


def test_to_int(spark):
    df = spark.createDataFrame([("12",), (" 12 ",), ("1.0",), ("12abc",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(text.to_int("s")).collect()] == [12, 12, None, None, None, None]


def test_labels(spark):
    df = spark.createDataFrame([(3, 12.25, 10.0, 0.04, 250.5)], "n int, a double, m double, lo double, hi double")
    assert df.select(text.distance_label("n", "a", "m", "lo", "hi")).first()[0] == "n = 3\nMean = 12.2 km\nMedian = 10 km\nRange = 0–250 km"
    fit = spark.createDataFrame([(9, 0.5, 0.25, -1.004, 2.125)], "n int, r double, r2 double, i double, s double")
    assert fit.select(text.regression_label("n", "r", "r2", "i", "s")).first()[0] == "n = 9\nr = 0.5\nR² = 0.25\nIndoor = -1 + 2.12 × Outdoor"


def test_clock_change(spark):
    df = spark.sql("select * from values (timestamp_ntz'2024-03-31 00:59:59'), (timestamp_ntz'2024-03-31 01:00:00'), "
                   "(timestamp_ntz'2024-10-27 00:59:59'), (timestamp_ntz'2024-10-27 01:00:00') as t(ts)")
    local = [r[0].strftime("%m-%d %H:%M:%S") for r in df.select(F.date_format(times.local_time("ts", "Europe/London"), "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")).collect()]
    assert local == ["03-31 00:59:59", "03-31 02:00:00", "10-27 01:59:59", "10-27 01:00:00"]


def test_floor_hour_keeps_type(spark):
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.sql(f"select {kind}'2024-03-04 10:59:59.123456' as ts").select(times.floor_hour("ts").alias("h"))
        assert dict(df.dtypes)["h"] == kind
        assert df.first().h == dt.datetime(2024, 3, 4, 10)


def test_epoch_keeps_fraction(spark):
    assert spark.sql("select timestamp_ntz'1970-01-02 00:00:00.25' as t").select(times.epoch_seconds("t")).first()[0] == 86400.25


def day_rows(spark, rows):
    return spark.createDataFrame(rows, "DateTime timestamp_ntz, device_id string, rco2 double, pm02 double, atmp double").withColumn("Date", F.to_date("DateTime"))


def test_strict_maximum_keeps_unknown_days(spark):
    df = day_rows(spark, [(at(1), "hot", 6000.0, 1.0, 1.0), (at(2), "hot", 1.0, 1.0, 1.0),
                          (at(1), "unknown", 6000.0, 1.0, 1.0), (at(2), "unknown", None, 1.0, 1.0),
                          (at(1), "edge", 5000.0, 1000.0, 50.0), (at(1), "warm", None, 1.0, 50.5)])
    assert values(Q.days_where(df, Q.plausible()), "device_id") == [("edge",), ("unknown",)]


@pytest.mark.parametrize("rule, counts", [
    (Q.FULL_DAY_MINUTES, {1080: False, 1081: True}), (Q.FULL_DAY_HOURS, {17: False, 18: True}), (Q.SCHOOL_DAY_MINUTES, {315: False, 316: True}),
    (Q.SCHOOL_DAY_QUARTERS, {20: False, 21: True}), (Q.SCHOOL_DAY_HOURS, {5: False, 6: True}),
])
def test_completeness_presets(spark, rule, counts):
    df = spark.createDataFrame([(n,) for n in counts], "device_id int").withColumn("i", F.explode(F.sequence(F.lit(1), "device_id")))
    df = df.withColumn("Date", F.lit("2024-03-04").cast("date"))
    assert values(Q.days_where(df, Q.complete(rule)), "device_id") == [(n,) for n, kept in counts.items() if kept]


def test_missing_ratio_limit_is_included(spark):
    df = spark.createDataFrame([("a", 1.0)] * 3 + [("a", None)] + [("b", 1.0)] * 2 + [("b", None)], "code string, v double").withColumn("Date", F.lit(T0.date()))
    assert values(Q.days_where(df, Q.mostly_present("v"), keys=("Date", "code")), "code") == [("a",)]


def test_occupancy_strict_and_lenient(spark):
    rows = [(at(9, m), d, v, None, None) for d, vs in {"full": [500.0] * 3, "hole": [500.0, 500.0, None], "low": [480.0] * 3}.items() for m, v in enumerate(vs)]
    rows += [(at(8, 59), "low", 9000.0, None, None), (at(16), "hole", None, None, None)]
    df = day_rows(spark, rows)
    strict, lenient = Q.Occupancy(rows=2), Q.Occupancy(rows=2, skip_missing=True)
    assert values(Q.days_where(df, Q.occupied(strict)), "device_id") == [("full",)]
    assert values(Q.days_where(df, Q.occupied(lenient)), "device_id") == [("full",), ("hole",)]


def test_gradient_follows_rows_and_ends_at_day(spark):
    rows = [(at(9, i), "a", 400.0 + 20 * i, None, None) for i in range(20)] + [(at(9, i, 1), "a", 5000.0, None, None) for i in range(20)]
    df = Q.with_co2_gradient(day_rows(spark, rows))
    grades = [r.co2_gradient for r in df.orderBy("DateTime").collect()]
    assert grades[:11] == [None] * 11
    assert grades[11:13] == [280.0, 280.0]
    assert grades[13:31] == [None] * 18
    assert values(Q.gradient_days(day_rows(spark, rows)), "Date") == [(T0.date(),)]


def test_gradient_needs_full_smoothing_frame(spark):
    rows = [(at(9, i), "a", None if i == 5 else 400.0 + 50 * i, None, None) for i in range(24)]
    grades = [r.co2_gradient for r in Q.with_co2_gradient(day_rows(spark, rows)).orderBy("DateTime").collect()]
    # Means end at rows 4 and 10 to 23; row 11 alone has one seven rows before and after.
    assert [i for i, g in enumerate(grades) if g is not None] == [11]


def test_gradient_outside_hours_does_not_count(spark):
    rows = [(at(16, i), "a", 400.0 + 100 * i, None, None) for i in range(30)]
    assert Q.gradient_days(day_rows(spark, rows)).count() == 0
    rows = [(at(15, 59 - 29 + i), "a", 400.0 + 100 * i, None, None) for i in range(30)]
    assert Q.gradient_days(day_rows(spark, rows)).count() == 1


def test_step_is_a_fall_and_crosses_midnight(spark):
    rows = [(at(23, 45), "fall", 900.0, None, None), (at(9, 0, 1), "fall", 650.0, None, None),
            (at(9), "rise", 400.0, None, None), (at(9, 15), "rise", 700.0, None, None),
            (at(9), "edge", 700.0, None, None), (at(9, 15), "edge", 500.0, None, None)]
    df = day_rows(spark, rows)
    assert values(Q.step_days(df), "device_id") == [("fall",)]
    assert values(Q.step_days(df, rising=True), "device_id") == [("rise",)]


def test_school_days(spark):
    # 2024-03-04 is a Monday; the term ends on Wednesday, so Thursday is the extra day.
    terms = spark.createDataFrame([("t", dt.date(2024, 3, 1), dt.date(2024, 3, 6)), ("u", dt.date(2024, 3, 6), dt.date(2024, 3, 6))], "term_name string, start_date date, end_date date")
    holidays = spark.createDataFrame([(dt.date(2024, 3, 5),)], "date date")
    rows = [(at(h, m, d), "a", 1.0, 1.0, 1.0) for d in range(-2, 6) for h, m in ((8, 59), (9, 0), (15, 59), (16, 0))]
    kept = school_days(day_rows(spark, rows), terms, holidays)
    assert values(kept, "DateTime") == [(at(h, m, d),) for d in (0, 2, 3) for h, m in ((9, 0), (15, 59))]


def test_devices_of_type(spark):
    schools = spark.createDataFrame([("S1", 1), ("S2", 2), ("S3", None)], "SchoolId_long string, MonitoringType int")
    dimension = spark.createDataFrame([("S1", "m1"), ("S1", "m1"), ("S2", "m2"), ("S2", None), ("S3", "m3")], "SchoolId_long string, MonitorReferenceId string")
    assert values(L.devices_of_type(schools, dimension, 1), "device_id") == [("m1",)]
    assert values(L.devices_of_type(schools, dimension, 2), "device_id") == [("m2",)]
    assert values(L.devices_of_type(schools, dimension), "device_id") == [("m1",), ("m2",), ("m3",)]


def test_monitor_dimension_repeats_and_latest_does_not(spark):
    requests = spark.createDataFrame([(1, "S1"), (2, "S1"), (3, "S2"), (4, None)], "request int, SchoolId_long string")
    schools = spark.createDataFrame([("S1", 10), ("S2", 20)], "SchoolId_long string, SchoolId_short int")
    monitors = spark.createDataFrame([(10, "m1"), (10, "m2"), (None, "spare")], "SchoolId_short int, MonitorReferenceId string")
    dimension = L.monitor_dimension(requests, schools, monitors)
    assert values(dimension, "request", "MonitorReferenceId") == [(1, "m1"), (1, "m2"), (2, "m1"), (2, "m2"), (4, "spare")]
    assert values(L.latest_per_monitor(dimension, F.col("request")), "MonitorReferenceId", "request") == [("m1", 2), ("m2", 2), ("spare", 4)]


def test_geocode_takes_pairs(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), ("D",), (None,)], "pc string")
    live = spark.createDataFrame([("A", 1.0, 2.0), ("B", None, 9.0), ("D", None, None)], "pc_clean string, latitude double, longitude double")
    retired = spark.createDataFrame([("A", 7.0, 7.0), ("B", 3.0, None), ("C", 5.0, 6.0)], "pc_clean string, latitude double, longitude double")
    out = {r.pc: (r.valid, r.SchoolLatitude, r.SchoolLongitude) for r in L.geocode(df, "pc", live, retired).collect()}
    assert out == {"A": (True, 1.0, 2.0), "B": (True, 3.0, None), "C": (False, 5.0, 6.0), "D": (True, None, None), None: (False, None, None)}


def test_union_aligned_in_any_order(spark):
    a, b, c = (spark.createDataFrame([(1, 2)], s) for s in ("x int, y int", "y int, z int", "z int, w int"))
    one = union_aligned(a, union_aligned(b, c)).select("w", "x", "y", "z").collect()
    two = union_aligned(union_aligned(a, b), c).select("w", "x", "y", "z").collect()
    assert sorted(one, key=str) == sorted(two, key=str)


def test_hourly_mean_skips_missing(spark):
    df = with_day(day_rows(spark, [(at(9, 5), "a", 1.0, None, None), (at(9, 55), "a", None, None, None), (at(10), "a", 5.0, None, None)]))
    out = R.hourly_means(df, ("rco2", "pm02"))
    assert values(out, "DateTime", "rco2", "pm02", "DateDevice") == [(at(9), 1.0, None, "2024-03-04 a"), (at(10), 5.0, None, "2024-03-04 a")]


def test_quartiles_interpolate(spark):
    df = day_rows(spark, [(at(i), "a", v, None, None) for i, v in enumerate((10.0, 1.0, 4.0, 2.0))])
    row = R.daily_summary(df, ("rco2", "pm02")).first()
    assert (row.rco2_q25, row.rco2_median, row.rco2_q75, row.pm02_median) == (1.75, 3.0, 5.5, None)


def test_window_means(spark):
    long = spark.createDataFrame([(at(0, 0) + dt.timedelta(seconds=s), "d", f, v) for s, f, v in ((5, "rco2", 1.0), (50, "rco2", 3.0), (59, "pm02", 7.0), (60, "rco2", 9.0), (180, "other", 1.0))],
                                 "ts timestamp_ntz, device_id string, field string, value double")
    out = R.window_means(long, "1 minute", ("rco2", "pm02"))
    assert values(out.na.fill(-1.0), "DateTime", "rco2", "pm02") == [(at(0, 0), 2.0, 7.0), (at(0, 1), 9.0, -1.0)]


def test_age_groups(spark):
    df = spark.createDataFrame([(1,), (4,), (5,), (None,)], "t int").withColumn("g", age_group("t"))
    assert [tuple(r) for r in df.select("g", generation_rate("g")).collect()] == [("Primary", 3.1), ("11-plus", 4.32), ("Mixed", 4.32), ("Mixed", 4.32)]


def test_ventilation_of_short_and_gappy_days(spark):
    devices = spark.createDataFrame([("a", 1, "S"), ("b", 4, "S")], "device_id string, SchoolType int, SchoolId_long string")
    rows = [(at(9), "a", 1412.0, None, None), (at(12), "a", 412.0, None, None), (at(9), "b", 900.0, None, None),
            (at(4), "a", 9999.0, None, None), (at(23), "a", 9999.0, None, None)]
    out = {r.device_id: r for r in by_ventilation(ventilation(day_rows(spark, rows), devices, by_school=True)).collect()}
    # The trapezoid spans three hours: 3 * 0.001 / 2.
    assert out["a"].pp_ventilation == pytest.approx(0.001 * 5 * 1.048 * 3.1 / 0.0015)
    assert out["a"].CO2_mean == 912.0 and out["a"].SchoolId_long == "S"
    assert out["b"].pp_ventilation is None and out["b"].CO2_mean == 900.0
    assert list(out) == ["a", "b"]


def test_missing_value_breaks_the_integral(spark):
    rows = [(at(9 + i), "a", v, None, None) for i, v in enumerate((1412.0, 1412.0, None, 1412.0))]
    out = with_running_integral(day_rows(spark, rows)).orderBy("DateTime").collect()
    assert [r.C_integral for r in out] == [0.0, pytest.approx(0.001), None, None]
    devices = spark.createDataFrame([("a", 1)], "device_id string, SchoolType int")
    assert ventilation(day_rows(spark, rows), devices).first().pp_ventilation is None


def test_regression(spark):
    xy = [(1.0, 2.0), (2.0, 2.5), (3.0, 4.5), (4.0, 4.0), (None, 9.0), (7.0, None)]
    fit = S.linear_fit(spark.createDataFrame(xy, "x double, y double"), "x", "y").first()
    # Least squares by hand: slope 0.8, intercept 1.25, residual sum 1.05.
    assert (fit.n, fit.slope, fit.intercept) == (4, pytest.approx(0.8), pytest.approx(1.25))
    assert fit.slope_se == pytest.approx((1.05 / 2 / 5) ** 0.5)
    flat = S.linear_fit(spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double"), "x", "y").first()
    assert flat.slope is None and flat.slope_se is None


def test_ratios_drop_zero_and_missing(spark):
    rows = [(1, at(1), 4.0, 2.0), (2, at(1), 4.0, 0.0), (3, at(1), None, 2.0), (4, at(1), 4.0, None)]
    df = spark.createDataFrame(rows, "SchoolId_short int, DateTime timestamp_ntz, pm02 double, pm2_5 double")
    assert values(S.annual_ratio(df, 2024), "SchoolId_short", "io_ratio") == [(1, 2.0)]
    assert values(S.seasonal_ratio(df, 2024), "SchoolId_short", "Season") == [(1, "Spring")]
    assert S.annual_ratio(df, 2023).count() == 0


def test_missing_keys_are_spread(spark):
    """Missing keys on both sides: the rows of a plain null-safe join, and no task of the larger side holds all of them."""
    rows = [(None if i % 3 else f"k{i % 5}", i % 4 or None, i) for i in range(600)]
    table = [(None, 1, "n1"), (None, None, "nn"), ("k1", None, "1n"), ("k1", 1, "11"), (None, 1, "again"), ("k9", 9, "none")]
    df = spark.createDataFrame(rows, "a string, b int, i int")
    ref = spark.createDataFrame(table, "a string, b int, label string")
    for how in ("left", "inner", "left_semi", "left_anti", "full"):
        plain = df.join(ref.withColumnsRenamed({"a": "x", "b": "y"}), F.expr("a <=> x AND b <=> y"), how).drop("x", "y")
        got = L.lookup(df, ref, ["a", "b"], how=how)
        assert got.columns == plain.columns and sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    values = F.pmod(F.xxhash64("a", "b", "i"), F.lit(L.PARTS))
    parts = df.where("a IS NULL").groupBy(values).count().collect()
    assert len(parts) == L.PARTS and max(r["count"] for r in parts) < 100
    empty = L.lookup(df.limit(0), ref.limit(0), ["a"])
    assert empty.count() == 0 and L.lookup(df, ref.limit(0), ["a"]).count() == 600
