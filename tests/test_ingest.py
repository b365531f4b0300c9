"""NaN on ingest, slices at the last reading, ranges at the scan, staged tables by thread."""

import threading

from pyspark.sql import functions as F

from airq.operators import stats
from airq.sources import series, slices, staging, tables


def test_nan_readings_are_missing(spark, tmp_path):
    long = spark.sql("""SELECT * FROM VALUES
        ('d', TIMESTAMP_NTZ '2025-01-01 00:00:10', 'rco2', double('nan')), ('d', TIMESTAMP_NTZ '2025-01-01 00:00:20', 'rco2', 400D),
        ('d', TIMESTAMP_NTZ '2025-01-01 00:01:10', 'rco2', double('nan')) AS t(device_id, ts, field, value)""")
    minutes = series.read_series(long, "2025-01-01", "2025-01-02", fields=["rco2"]).collect()
    assert [r["rco2"] for r in minutes if r["rco2"] is not None] == [400.0]
    hourly = spark.sql("SELECT 'a' AS code, TIMESTAMP_NTZ '2025-01-01 00:00:00' AS date, double('nan') AS pm2_5")
    assert series.station_readings(hourly, hourly.select("code")).first()["pm2_5"] is None
    (tmp_path / "x.csv").write_text("name,v\na,NaN\nb,1.5\n")
    got = tables.read_csv(spark, str(tmp_path / "x.csv"), {"name": ("name", "string"), "v": ("v", "double")})
    assert [r["v"] for r in got.orderBy("name").collect()] == [None, 1.5]


def test_last_reading_is_in_a_slice(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2025-01-01 00:00:00'), (TIMESTAMP_NTZ '2025-01-01 00:20:00') AS t(ts)")
    cut = slices.slices_of(df, "10 minutes")
    assert cut.where("slice_start >= slice_end").isEmpty()
    inside = df.join(cut, (F.col("ts") >= F.col("slice_start")) & (F.col("ts") < F.col("slice_end")))
    assert cut.count() == 3 and inside.count() == 2


def test_year_is_a_range_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 'a' AS SchoolId_short, TIMESTAMP_NTZ '2024-12-31 23:59:59' AS DateTime, 1D AS pm02, 2D AS pm2_5").write.parquet(path)
    df = spark.read.parquet(path)
    for year, n in ((2024, 1), (2025, 0)):
        means = stats.annual_means(df, year)
        plan = means._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(DateTime" in plan and "LessThan(DateTime" in plan
        assert means.count() == n


def test_blocks_of_two_threads_keep_their_tables(spark):
    ready, done, left = threading.Event(), threading.Event(), []

    def other():
        with staging.staged_within(spark):
            df = staging.stage(spark.range(3), "other")
            ready.set()
            done.wait(60)
            left.append(df.count())

    thread = threading.Thread(target=other)
    thread.start()
    ready.wait(60)
    with staging.staged_within(spark):
        mine = staging.stage(spark.range(5), "mine")
        assert mine.count() == 5
    done.set()
    thread.join()
    assert left == [3]
