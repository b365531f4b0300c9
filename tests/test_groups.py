"""Large groups: the block-wise plans give exactly what the direct plans give."""

import math
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.operators import groups as G
from airq.operators import quality as Q
from airq.operators.rollup import ensemble
from airq.operators.ventilation import with_running_integral

KEYS = ["k", "d"]


@pytest.fixture(scope="module")
def skewed(spark):
    """Most rows in one group; a NULL key group, missing values, repeated values and times."""
    random.seed(3)
    rows = []
    for i in range(3000):
        key = ("hot", 1) if i % 3 else (random.choice(["a", "b", None]), random.choice([1, 2, None]))
        value = None if random.random() < 0.02 else float(random.choice([random.randint(0, 50), random.random() * 100]))
        rows.append((*key, i, random.randint(0, 900), value))
    return spark.createDataFrame(rows, "k string, d int, id int, t int, v double").cache()


def rows_of(df, *names):
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for p, q in zip(x, y):
            assert p == q or (p is not None and q is not None and p == pytest.approx(q, rel=1e-9))


@pytest.mark.parametrize("chunk_rows,slot", [(40, 7), (333, 60), (1, 10_000), (100, 0.5)])
def test_row_windows(skewed, chunk_rows, slot):
    steps = [
        {"m": lambda w: F.avg("v").over(w.rowsBetween(-4, 0)), "n": lambda w: F.count("v").over(w.rowsBetween(-4, 0))},
        {"g": lambda w: F.lead("m", 7).over(w) - F.lag("m", 7).over(w), "first": lambda w: F.lag("id", 1, -1).over(w)},
    ]
    names = [*KEYS, "id", "m", "n", "g", "first"]
    direct = G.with_row_windows(skewed, KEYS, ["t", "id"], steps, 11, 7, bounded=True)
    blocks = G.with_row_windows(skewed, KEYS, ["t", "id"], steps, 11, 7, chunk_rows=chunk_rows, slot=slot)
    assert blocks.columns == direct.columns and blocks.count() == skewed.count()
    close(rows_of(blocks, *names), rows_of(direct, *names))


@pytest.mark.parametrize("slot", [1, 60, 10_000])
def test_running_sum(skewed, slot):
    late_hole = skewed.withColumn("v", F.when((F.col("t") < 700) | F.col("v").isNotNull(), F.coalesce("v", F.lit(1.0))))
    direct = G.with_running_sum(late_hole, KEYS, ["t", "id"], "v", "s", bounded=True)
    blocks = G.with_running_sum(late_hole, KEYS, ["t", "id"], "v", "s", slot=slot)
    close(rows_of(blocks, *KEYS, "id", "s"), rows_of(direct, *KEYS, "id", "s"))
    hot = direct.where("k = 'hot'")
    assert hot.where("s is null").count() > 0 and hot.where("s is not null").count() > 0


def test_quantiles(skewed):
    df = skewed.withColumn("w", F.when(F.col("k") != "hot", F.col("t").cast("double")))
    levels = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    direct = G.group_quantiles(df, KEYS, ["v", "w"], levels, bounded=True)
    blocks = G.group_quantiles(df, KEYS, ["v", "w"], levels)
    names = [*KEYS, "v_mean", "w_mean", *[F.col(f"{m}_q")[i] for m in ("v", "w") for i in range(len(levels))]]
    close(rows_of(blocks, *names), rows_of(direct, *names))


def test_quantiles_of_everything(skewed):
    direct = G.group_quantiles(skewed, [], ["v"], [0.1, 0.5], bounded=True).first()
    blocks = G.group_quantiles(skewed, [], ["v"], [0.1, 0.5]).first()
    assert blocks.v_q == pytest.approx(direct.v_q) and blocks.v_mean == pytest.approx(direct.v_mean)


def test_quantiles_of_any_values(spark):
    """All sizes and signs, powers of two, neighbours that differ in the last bit, ties, groups without a value."""
    random.seed(11)
    values = [0.0, -0.0, 5e-324, 1e-310, 1.7e308, -1.7e308, 1.0, 2.0, 4.0, math.nextafter(2, 0), math.nextafter(2, 3), float("inf"), float("-inf"), None]
    values += [random.choice([-1, 1]) * 10 ** random.uniform(-12, 12) for _ in range(300)] + [math.nextafter(7, 8 if i % 2 else 0) for i in range(40)] + [7.0] * 200
    rows = [(random.choice(["a", "b", None]), v) for v in values for _ in range(2)] + [("none", None)] * 3
    df = spark.createDataFrame(rows, "k string, v double")
    levels = [0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0]
    finite = df.where(F.col("v").isNull() | (F.abs("v") < float("inf")))
    names = ["k", *[F.col("v_q")[i] for i in range(len(levels))]]
    close(rows_of(G.group_quantiles(finite, ["k"], ["v"], levels), *names), rows_of(G.group_quantiles(finite, ["k"], ["v"], levels, bounded=True), *names))
    ends = G.group_quantiles(df, [], ["v"], [0.0, 1.0]).first()
    assert ends.v_q == [float("-inf"), float("inf")]


def test_value_slots_ascend(spark):
    random.seed(12)
    values = sorted({random.choice([-1, 1]) * 2 ** random.uniform(-1074, 1023) for _ in range(3000)} | {s * 2.0**e for s in (-1, 1) for e in range(-60, 60)} | {
        math.nextafter(s * 2.0**e, t) for s in (-1, 1) for e in range(-60, 60) for t in (-1e9, 1e9)} | {0.0, float("inf"), float("-inf")})
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", G._value_slot(F.col("v")).alias("s")).collect()
    slots = [r.s for r in sorted(rows, key=lambda r: r.v)]
    assert slots == sorted(slots) and len(set(slots)) > 1000


def test_plans_start_no_job(spark, skewed):
    """Whatever the data, the plan of a window, a running sum, a quantile or a cleaning is made without looking at them."""
    df = spark.range(2000).select(
        F.lit("2024-03-04").cast("date").alias("Date"), F.lit("d").alias("device_id"), F.col("id").cast("timestamp").alias("DateTime"), F.col("id").cast("double").alias("rco2"))
    skewed.count()
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        made = [
            G.with_row_windows(skewed, KEYS, ["t", "id"], [{"p": lambda w: F.lag("v", 1).over(w)}], 1, 0),
            G.with_running_sum(skewed, KEYS, ["t", "id"], "v", "s"), G.group_quantiles(skewed, KEYS, ["v"], [0.5]), G.group_quantiles(skewed, [], ["v"], [0.5]),
            Q.clean_co2_minutes(df), Q.clean_co2_quarters(df), Q.gradient_days(df), Q.step_days(df), with_running_integral(df), ensemble(df, "DateTime", ["rco2"]),
        ]
        for m in made:
            m._jdf.queryExecution().executedPlan()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("plans")) == 0
        assert made[2].count() and len(spark.sparkContext.statusTracker().getJobIdsForGroup("plans")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_steps_across_midnight_and_gaps(spark):
    """The step rule by days equals the rule over each device's whole life, with days missing and rows missing a value."""
    random.seed(5)
    rows = []
    for device in ("a", "b", "c", None):
        for day in range(1, 25):
            if random.random() < 0.3:
                continue
            for hour in random.sample(range(24), random.randint(1, 6)):
                rows.append((device, day, hour, random.choice([None, 400.0, 700.0, 1000.0])))
    df = spark.createDataFrame(rows, "device_id string, day int, hour int, rco2 double")
    df = df.select("device_id", F.make_date(F.lit(2024), F.lit(1), "day").alias("Date"), F.make_timestamp_ntz(F.lit(2024), F.lit(1), "day", "hour", F.lit(0), F.lit(0)).alias("DateTime"), "rco2")
    life = W.partitionBy("device_id").orderBy("DateTime")
    for rising in (False, True):
        for threshold in (200, 400):
            old, new = F.lag("rco2", 1).over(life), F.col("rco2")
            found = df.withColumn("s", new - old if rising else old - new).where((F.col("s") > threshold) & F.hour("DateTime").between(9, 15)).select("Date", "device_id").distinct()
            for limits in ({}, {"bounded": True}, {"chunk_rows": 3, "slot": 7200}):
                assert rows_of(Q.step_days(df, threshold, rising, **limits), "Date", "device_id") == rows_of(found, "Date", "device_id")


def test_first_per_key(skewed):
    ranked = skewed.withColumn("n", F.row_number().over(W.partitionBy(*KEYS).orderBy("t", "id"))).where("n = 1")
    assert rows_of(G.first_per_key(skewed, KEYS, [F.col("t"), F.col("id")]), *KEYS, "id") == rows_of(ranked, *KEYS, "id")


def test_gradient_days_with_a_hot_day(spark):
    n = 4000
    df = spark.range(n).select(
        F.lit("2024-03-04").cast("date").alias("Date"),
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("d"), (F.col("id") % 40).cast("string"))).alias("device_id"),
        (F.lit("2024-03-04 09:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id"))).alias("DateTime"),
        "id", (400 + F.pmod(F.hash("id"), F.lit(300))).cast("double").alias("rco2"))
    for threshold in (60, 120, 180):
        direct = Q.gradient_days(df, threshold, order=("DateTime", "id"), bounded=True)
        blocks = Q.gradient_days(df, threshold, order=("DateTime", "id"), chunk_rows=150, slot=30)
        assert rows_of(direct, "device_id") == rows_of(blocks, "device_id")
    assert rows_of(Q.step_days(df, 200, order=("DateTime", "id")), "device_id") == rows_of(
        Q.step_days(df, 200, order=("DateTime", "id"), chunk_rows=150, slot=30), "device_id")


def test_cleaning_with_a_hot_device(spark):
    """The whole minute and quarter-hour cleaning with most rows in one device-day."""
    n = 3000
    df = spark.range(n).select(
        F.lit("2024-03-04").cast("date").alias("Date"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("d"), (F.col("id") % 30).cast("string"))).alias("device_id"),
        (F.lit("2024-03-04 08:50:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id"))).alias("DateTime"),
        "id", (400 + F.pmod(F.hash("id"), F.lit(300))).cast("double").alias("rco2"))
    rule = Q.Occupancy(rows=10, mean_co2=480)
    for clean in (Q.clean_co2_minutes, Q.clean_co2_quarters):
        for threshold in (100, 170, 250, 290):
            direct = clean(df, rule, threshold, order=("DateTime", "id"), bounded=True)
            blocks = clean(df, rule, threshold, order=("DateTime", "id"), chunk_rows=120, slot=45)
            assert rows_of(direct, "id") == rows_of(blocks, "id")
