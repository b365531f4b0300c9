"""Physical plans: what reaches the scan, what is shuffled, what never happens."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from airq.operators import quality as Q
from airq.operators import rollup as R
from airq.operators import stats as S
from airq.operators.calendars import school_days
from airq.operators.ventilation import ventilation
from airq.plans.indoor import CleaningRules, indoor_minutes
from airq.sources import series
from checks.queries import ORDER, QUERIES
from checks.views import READING_MEASURES, Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture()
def plain(spark):
    """Plans as written: no broadcast, no adaptive changes."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "2000"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield Tables(spark, FOLDER)
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def count(text, operator):
    return len(re.findall(rf"(?m)^[\s:|*()\d+-]*{operator}\b", text))


def test_range_reaches_the_scan(plain):
    text = plan(series.read_series(plain.readings_long(), "2024-01-05", "2024-01-06", "1 hour", ("click",)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for predicate in ("GreaterThanOrEqual(ts", "LessThan(ts", "EqualTo(event_type,click)"):
        assert predicate in pushed
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>", text)
    assert count(text, "Exchange") == 1


def test_rules_are_one_aggregation(plain):
    days = Q.days_where(plain.readings(), Q.complete(Q.FULL_DAY_MINUTES), Q.plausible({"pm02": 1000, "rco2": 5000}), Q.occupied())
    text = plan(days)
    assert count(text, "Exchange") == 1 and count(text, "HashAggregate") == 2 and count(text, "SortAggregate") == 0


def test_bounded_cleaning_moves_the_readings_once(plain):
    rules = CleaningRules(extremes={"pm02": 1000, "rco2": 5000}, order=ORDER)
    text = plan(indoor_minutes(plain.readings(), rules=rules))
    # All rules and windows share one exchange and one sort of one scan.
    assert count(text, "Exchange") == 1 and count(text, "Window") == 4 and count(text, "Sort") == 1 and text.count("FileScan parquet") == 1


def test_whole_chain_reads_the_readings_once(spark, plain):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")  # the devices are few
    text = plan(QUERIES["indoor_minutes_from_long"].build(plain))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert sum("event_type" in scan for scan in scans) == 1
    # The readings move for the window means and for the days; the other exchanges hold devices.
    fact = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if "device_id" in x and ("Date" in x or "window" in x)]
    assert len(fact) == 2 and any(x.startswith("Date, device_id") for x in fact)


def test_nearest_measures_positions_not_days(spark):
    """Measured pairs do not grow with the days, and nothing is joined by the day alone."""
    from airq.operators import nearest

    sites = spark.range(30).select((F.col("id") * 0.3 + 50).alias("lat"), (F.col("id") * 0.2).alias("lon"))
    stations = spark.range(40).select(F.col("id").alias("code"), (F.col("id") * 0.25 + 49.9).alias("lat"), (F.col("id") * 0.21).alias("lon"))
    measured = {}
    whole = nearest.with_distance_m

    for days in (1, 20):
        dates = spark.range(days).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("Date"))
        counts = []

        def counted(df, *names):
            counts.append(df.count())
            text = plan(df)
            assert "Date" not in text
            return whole(df, *names)

        nearest.with_distance_m = counted
        try:
            got = nearest.nearest_reporting(dates.crossJoin(sites), dates.crossJoin(stations))
        finally:
            nearest.with_distance_m = whole
        measured[days] = counts
        assert got.count() == 30 * days
    assert measured[1] == measured[20] and sum(measured[1]) < 30 * 40


def test_ventilation_shuffles_readings_once(plain):
    text = plan(ventilation(plain.readings(), plain.sites(), order=ORDER, bounded=True))
    fact = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)]
    assert sum(x.startswith("Date, device_id") for x in fact) == 1


def test_hour_means_aggregate_by_hash(plain):
    from airq.functions.text import date_device

    text = plan(R.hourly_means(plain.readings().withColumn("DateDevice", date_device()), READING_MEASURES))
    assert count(text, "SortAggregate") == 0 and count(text, "Exchange") == 1


def test_statistics_read_only_their_columns(plain):
    text = plan(S.linear_fit(plain.table("lineitem"), "l_quantity", "l_extendedprice"))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in text


def test_school_days_are_one_join(plain):
    text = plan(school_days(plain.readings().select("reading_id", "DateTime", "Date"), plain.terms(), plain.holidays()))
    assert text.count("LeftSemi") == 1
    assert "value" not in re.search(r"ReadSchema: struct<event_id[^>]*>", text).group(0)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"month_tables", "period_tables", "figure_labels", "distance_summary"}))
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(QUERIES[name].build(Tables(spark, FOLDER)))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert operator not in text


def test_unbounded_groups_are_not_windowed_whole(spark):
    """Unless a bound is declared no window holds a day's rows: those of a slot are numbered, those of a chunk computed."""
    df = spark.range(2000).select(
        F.lit(dt.date(2024, 3, 4)).alias("Date"), F.lit("d").alias("device_id"), F.col("id").cast("timestamp").cast("timestamp_ntz").alias("DateTime"),
        F.col("id").cast("double").alias("rco2"))
    text = plan(Q.with_co2_gradient(df))
    windows = re.findall(r"windowspecdefinition\(([^)]*)\)", text)
    per_row = [w for w in windows if "_slot ASC" not in w]
    assert per_row and all("_chunk" in w or "_slot" in w for w in per_row)
