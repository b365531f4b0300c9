"""The grid search against comparing every pair."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from airq.functions.geo import with_distance_m
from airq.operators import nearest as N

D = [dt.date(2024, 1, i) for i in range(1, 6)]


def brute_force(sites, stations):
    pairs = sites.where("lat is not null and lon is not null").distinct().join(
        stations.select("Date", "code", F.col("lat").alias("a"), F.col("lon").alias("b")), "Date")
    measured = with_distance_m(pairs, "m", "lat", "lon", "a", "b").where("m is not null")
    best = measured.groupBy("Date", "lat", "lon").agg(F.min(F.struct(F.round("m", 4).alias("r"), "code", "m")).alias("x"))
    return best.select("Date", "lat", "lon", "x.code", "x.m")


def check(spark, site_rows, station_rows):
    sites = spark.createDataFrame(site_rows, "Date date, lat double, lon double")
    stations = spark.createDataFrame(station_rows, "Date date, code int, lat double, lon double")
    got = {tuple(r)[:3]: (r.code, r.metres) for r in N.nearest_reporting(sites, stations).collect()}
    want = {tuple(r)[:3]: (r.code, r.m) for r in brute_force(sites, stations).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    for k, (_, metres) in got.items():
        assert metres == pytest.approx(want[k][1], abs=1e-4)
    return got


@pytest.mark.parametrize("seed, box, n", [(1, (50, 58, -7, 1), 40), (2, (-89.9, 89.9, -180, 180), 25), (3, (51.4, 51.6, -0.3, 0.1), 120), (4, (60, 89, 175, 180), 6)])
def test_equals_brute_force(spark, seed, box, n):
    rnd = random.Random(seed)

    def point():
        return round(rnd.uniform(box[0], box[1]), 3), round(rnd.uniform(box[2], box[3]), 3)

    codes = {c: point() for c in range(n)}
    codes[n] = (codes[0][0], -codes[0][1])
    codes[n + 1] = codes[1]
    stations = [(d, c, *p) for d in D[:4] for c, p in codes.items() if rnd.random() < 0.7]
    places = [point() for _ in range(60)] + [(-p[0], p[1]) for p in list(codes.values())[:5]] + list(codes.values())[:3]
    sites = [(d, *p) for d in D for p in places] + [(D[0], None, 1.0), (D[0], 1.0, None)]
    got = check(spark, sites, stations)
    assert D[4] not in {k[0] for k in got} and len(got) >= 4 * 60


def test_equal_distance_goes_to_the_smaller_code(spark):
    got = check(spark, [(D[0], 52.0, 0.0)], [(D[0], 8, 52.0, 0.5), (D[0], 3, 52.0, -0.5), (D[0], 9, 52.0, -0.5)])
    assert got[(D[0], 52.0, 0.0)][0] == 3


def test_across_the_date_line(spark):
    got = check(spark, [(D[0], 10.0, 179.99)], [(D[0], 1, 10.0, -179.99), (D[0], 2, 10.0, 179.0)])
    assert got[(D[0], 10.0, 179.99)][0] == 1


def vincenty(lat1, lon1, lat2, lon2):
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = math.atan((1 - f) * math.tan(math.radians(lat1))), math.atan((1 - f) * math.tan(math.radians(lat2)))
    big = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        ss = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(ss, cs)
        sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        ca = 1 - sa * sa
        cm = cs - 2 * math.sin(u1) * math.sin(u2) / ca if ca else 0.0
        c = f / 16 * ca * (4 + f * (4 - 3 * ca))
        new = big + (1 - c) * f * sa * (sigma + c * ss * (cm + c * cs * (2 * cm * cm - 1)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    uu = ca * (a * a - b * b) / (b * b)
    ka = 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu)))
    kb = uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))
    ds = kb * ss * (cm + kb / 4 * (cs * (2 * cm * cm - 1) - kb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
    return b * ka * (sigma - ds)


def test_distance_accuracy(spark):
    rnd = random.Random(5)
    rows = [(rnd.uniform(50, 59), rnd.uniform(-7, 1.5), rnd.uniform(50, 59), rnd.uniform(-7, 1.5)) for _ in range(300)]
    df = with_distance_m(spark.createDataFrame(rows, "a double, b double, c double, d double"), "m", "a", "b", "c", "d")
    for r in df.collect():
        assert r.m == pytest.approx(vincenty(r.a, r.b, r.c, r.d), abs=0.005)
    same = with_distance_m(spark.createDataFrame([(1.0, 2.0, 1.0, 2.0), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double"), "m", "a", "b", "c", "d")
    assert [r.m for r in same.collect()] == [0.0, pytest.approx(math.pi * 6378137.0)]


def test_link_keeps_rows_once(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    indoor = spark.createDataFrame(
        [(D[0], t[0], "x", 1, 52.0, 0.0, 5.0), (D[0], t[0], "y", 1, 52.0, 0.0, 6.0), (D[0], t[1], "x", 1, 52.0, 0.0, 7.0),
         (D[0], t[0], "z", 2, None, None, 8.0), (D[1], t[0], "x", 1, 52.0, 0.0, 9.0)],
        "Date date, DateTime timestamp_ntz, device_id string, SchoolId_short int, SchoolLatitude double, SchoolLongitude double, pm10 double")
    outdoor = spark.createDataFrame(
        [(D[0], t[0], "A", 52.1, 0.0, 1.5, "near"), (D[0], t[2], "A", 52.1, 0.0, 2.5, "near"), (D[0], t[0], "B", 55.0, 0.0, 3.5, "far")],
        "Date date, DateTime timestamp_ntz, code string, latitude double, longitude double, pm10 double, site string")
    out = N.link_outdoor(indoor, outdoor)
    got = sorted(((r.device_id, r.DateTime.hour, r.closest_station, r.pm10, r.pm10_out, r.site) for r in out.collect()), key=str)
    assert got == [("x", 0, "A", 5.0, 1.5, "near"), ("x", 1, "A", 7.0, None, None), ("y", 0, "A", 6.0, 1.5, "near")]


def test_any_station_code_wins_a_tie_by_its_order(spark):
    """Equal distances go to the smaller code; codes are compared as they are, not by a number of their own."""
    sites = spark.createDataFrame([(D[0], 52.0, 0.0)], "Date date, lat double, lon double")
    stations = spark.createDataFrame(
        [(D[0], "Z1", 52.0, 0.01), (D[0], "A9", 52.0, -0.01), (D[0], None, 52.0, 0.001)], "Date date, code string, lat double, lon double")
    assert [r.code for r in N.nearest_reporting(sites, stations).collect()] == ["A9"]
