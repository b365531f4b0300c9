"""Readers and writers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airq.sources import outputs, schemas, series, slices, staging, tables


def test_csv_names_types_and_missing(spark, tmp_path):
    folder = tmp_path / "in" / "deep"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("PhaseOfEducation (name),URN,extra,PercentageFSM,SchoolCapacity,NumberOfPupils\nPrimary,1,x,2.5,100,NA\n ,z,,NA,,7\n")
    (folder / "b.txt").write_text("not,a,table\n")
    df = tables.read_csv(spark, str(tmp_path / "in"), schemas.REGISTER_ENGLAND_WALES, pattern="*.csv", recursive=True)
    assert df.columns == list(schemas.REGISTER_ENGLAND_WALES)
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "Primary", 2.5, 100, None), (None, None, None, None, 7)]
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(folder / "a.csv"), {"x": ("absent", "int")})


def test_calendar_files(spark, tmp_path):
    (tmp_path / "terms.csv").write_text("academic_year,term_name,start_date,end_date\n2024,autumn,2024-09-02,2024-12-20\n")
    row = tables.read_csv(spark, str(tmp_path / "terms.csv"), schemas.TERMS).first()
    assert (row.start_date, row.end_date) == (dt.date(2024, 9, 2), dt.date(2024, 12, 20))


def test_range_is_half_open(spark):
    df = spark.sql("select timestamp_ntz'2024-01-31 23:59:59' as ts, 'a' as device_id union all select timestamp_ntz'2024-02-01 00:00:00', 'b'")
    assert [r.device_id for r in series.in_range(df, "2024-01-01", "2024-02-01").collect()] == ["a"]
    assert [r.device_id for r in series.in_range(df, "2024-01-31 23:59:59", "2024-02-02", devices=["b"]).collect()] == ["b"]


def test_stations_of_unknown_kind_stay(spark):
    meta = spark.createDataFrame([("A", "Urban Traffic"), ("B", "Urban Background"), ("C", None)], "code string, site_type string")
    assert {r.code for r in series.background_stations(meta).collect()} == {"B", "C"}
    hourly = spark.sql("select 'B' as code, timestamp'2023-12-31 23:00:00' as date union all select 'B', timestamp'2025-01-01 00:00:00' union all select 'A', timestamp'2024-06-01 00:00:00'")
    assert series.station_readings(hourly, series.background_stations(meta), [2023, 2025]).count() == 2
    assert series.station_readings(hourly, series.background_stations(meta), [2023, 2024]).count() == 1


def test_slices(spark):
    rows = slices.time_slices(spark, "2024-01-01", "2024-01-01 00:25:00", "10 minutes").orderBy("slice_start").collect()
    assert [(r.slice_start.minute, r.slice_end.minute) for r in rows] == [(0, 10), (10, 20), (20, 25)]
    months = slices.time_slices(spark, "2024-01-01", "2025-01-01", "1 month").collect()
    assert len(months) == 12 and max(r.slice_end for r in months) == dt.datetime(2025, 1, 1)


def test_months_resume_after_a_break(spark, tmp_path):
    root, made = str(tmp_path / "out"), []
    months = [dt.date(2024, 11, 1), dt.date(2024, 12, 1)]

    def make(month, keep):
        made.append(month)
        if month.month == 12 and len(made) == 2:
            return {"a": spark.range(5), "b": spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))}
        return {"a": spark.range(month.month), "b": spark.range(1).withColumn("x", F.lit(1))}

    with pytest.raises(Exception, match="lost"):
        outputs.write_months(spark, root, months, make)
    assert outputs.finished_months(spark, root) == months[:1]
    assert outputs.read_months(spark, root, ["a"])["a"].count() == 11
    assert outputs.write_months(spark, root, months, make) == months[1:]
    assert outputs.write_months(spark, root, months, make) == []
    assert made == [months[0], months[1], months[1]]
    back = outputs.read_months(spark, root, ["a", "b"])
    assert {r.month: r.n for r in back["a"].groupBy("month").agg(F.count("*").alias("n")).collect()} == {11: 11, 12: 12}
    assert set(back["b"].columns) == {"id", "x", "year", "month"}


def test_staged_table_is_read_back(spark):
    df = spark.range(10).withColumn("t", F.lit("2024-01-01").cast("timestamp_ntz"))
    staged = staging.stage(df, "test")
    assert staged.dtypes == df.dtypes and staged.count() == 10
    assert "Range" not in staged._jdf.queryExecution().toString()


def test_progress_columns_as_text(spark, tmp_path):
    spark.range(2).select(*[F.lit(1).alias(c) for c in schemas.PROGRESS_COLUMNS]).write.parquet(str(tmp_path / "p"))
    df = tables.read_columns(spark, str(tmp_path / "p"), schemas.PROGRESS_COLUMNS, schemas.PROGRESS_TEXT)
    assert dict(df.dtypes)["StepsState"] == "string" and dict(df.dtypes)["Id"] == "int"


def test_staged_tables_are_released(spark):
    staged = staging.stage(spark.range(3), "released")
    path = staged.inputFiles()[0]
    assert staging.release_staged(spark) >= 1
    assert not outputs._exists(spark, path)


def test_month_tables_are_written_once(spark, tmp_path):
    """A kept table is read from its final place by those made from it, and the manifest names every table."""
    root, month = str(tmp_path / "kept"), dt.date(2024, 5, 1)
    seen = {}

    def make(month, keep):
        base = keep("base", spark.range(7).withColumn("x", F.rand()))
        seen["base"] = sorted(r.x for r in base.collect())
        return {"base": base, "sum": base.agg(F.sum("x").alias("total"))}

    assert outputs.write_months(spark, root, [month], make) == [month]
    back = outputs.read_months(spark, root, ["base", "sum"])
    assert sorted(r.x for r in back["base"].collect()) == seen["base"]  # random numbers were not drawn again
    assert back["sum"].first().total == pytest.approx(sum(seen["base"]))
    assert outputs._manifests(spark, root) == {month: {"base", "sum"}}
    with pytest.raises(FileNotFoundError):
        outputs.read_months(spark, root, ["absent"])
    with pytest.raises(ValueError):
        outputs.write_months(spark, root, [dt.date(2024, 6, 1)], lambda m, keep: {"a": keep("a", spark.range(1)), "b": keep("a", spark.range(1))})


def test_broken_snapshot_leaves_the_old_state_whole(spark, tmp_path):
    root = str(tmp_path / "snap")
    lost = spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        outputs.write_snapshot({"a": spark.range(1), "b": lost}, root)
    with pytest.raises(FileNotFoundError):
        outputs.read_snapshot(spark, root, ["a"])
    outputs.write_snapshot({"a": spark.range(3), "b": spark.range(4)}, root)
    with pytest.raises(Exception, match="lost"):
        outputs.write_snapshot({"a": spark.range(30), "b": lost}, root)
    sizes = lambda: {n: df.count() for n, df in outputs.read_snapshot(spark, root, ["a", "b"]).items()}
    assert sizes() == {"a": 3, "b": 4}
    open_reader = outputs.read_snapshot(spark, root, ["a"])["a"]
    outputs.write_snapshot(lambda keep: {"a": (a := keep("a", spark.range(5))), "b": a.where("id > 3")}, root, spark)
    assert sizes() == {"a": 5, "b": 1} and open_reader.count() == 3
    outputs.write_snapshot({"a": spark.range(6), "b": spark.range(6)}, root)
    assert sizes() == {"a": 6, "b": 6} and len(outputs._snapshots(spark, root)) == 2


def test_staged_folders_are_pruned(spark):
    table = staging.stage(spark.range(100).withColumn("part", F.col("id") % 4), "parts", by=["part"])
    one = table.where("part = 2")
    assert one.count() == 25 and "PartitionFilters: [isnotnull(part" in one._jdf.queryExecution().executedPlan().toString()


def test_release_of_single_tables(spark):
    kept, gone = staging.stage(spark.range(5), "kept"), staging.stage(spark.range(6), "gone")
    path = gone.inputFiles()[0].rsplit("/", 1)[0]
    assert staging.release(gone) == 1 and not outputs._exists(spark, path) and kept.count() == 5


def test_staging_leaves_no_shuffle_files(spark):
    before = spark.conf.get(staging.CLEANUP, None)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with staging.shuffles_removed(spark):
        staged = staging.stage(grouped, "grouped")
        assert spark.conf.get(staging.CLEANUP) == "true"  # an inner block does not end the outer one's
    assert spark.conf.get(staging.CLEANUP, None) == before
    assert sorted(staged.collect()) == sorted(grouped.collect())  # a table read again is made again
