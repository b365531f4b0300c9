"""The nearest outdoor station among those that report on a day.

Distances depend on positions alone, so they are measured once per pair of a
site's and a station's position, however many days there are. Positions meet on
grid cells, not pairwise: at one cell size, each site sees the stations of its
own and the eight adjacent cells, an equi join on the cell. Those closer than anything
outside the nine cells can be, ranked by distance, are the site's candidates;
each site-day takes the first candidate that reports on its day. Only site-days without one
go on, to larger cells and longer lists; the last cells cover the globe. The answer is exact at every step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.functions.aggregates import n_rows
from airq.functions.geo import with_distance_m
from airq.operators.align import union_aligned
from airq.sources.staging import stage

# Cell sizes in degrees; each divides 360, so cells close around the globe. Nine cells of the last are the whole globe.
CELL_DEGREES = (0.0625, 0.125, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 120.0)
STATIONS_PER_CELL = 16
# Candidates of a site at the first cell size; four times as many at each next one, all at the last.
CANDIDATES = 8

# Lower bounds for an exact search on the ellipsoid: metres per degree of
# latitude and polar radius, reduced by one per cent.
_M_PER_DEGREE = 0.99 * 110_574.0
_RADIUS_M = 0.99 * 6_356_752.0


def _cell(c: str, degrees: float) -> Column:
    return F.floor(F.col(c) / degrees)


def _columns(degrees: float) -> Column:
    return F.lit(int(360 / degrees)).cast("bigint")


def _safe_radius(degrees: float) -> Column:
    """Metres within which no point outside the nine cells can lie."""

    def gap(c: str) -> Column:
        inside = F.col(c) - F.floor(F.col(c) / degrees) * degrees
        return degrees + F.least(inside, degrees - inside)

    across = F.asin(F.sin(F.radians(gap("lon"))) * F.cos(F.radians(F.col("lat")))) * _RADIUS_M
    return F.least(gap("lat") * _M_PER_DEGREE, across)


def _first_size(stations: DataFrame) -> int:
    """Index of the largest cell size at which no cell is crowded."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("i"), _cell("lat", d).alias("y"), _cell("lon", d).alias("x")) for i, d in enumerate(CELL_DEGREES)])
    counts = stations.select(F.explode(cells).alias("c")).groupBy("c").agg(n_rows().alias("n"))
    crowded = {r.i: r.n for r in counts.groupBy("c.i").agg(F.max("n").alias("n")).collect()}
    fitting = [i for i, n in crowded.items() if n <= STATIONS_PER_CELL and i < len(CELL_DEGREES) - 1]
    return max(fitting, default=0)


def _candidates(sites: DataFrame, stations: DataFrame, degrees: float, most: int | None) -> DataFrame:
    """Per site position the nearest station positions ``_lat, _lon`` and how ``far`` they are, the first ``most`` and their ties.

    No position outside the list is closer than one in it, unless it stands behind it in rank. Without ``most`` all
    positions of the nine cells are listed. Distances are whole tenths of a millimetre: so equal ones tie despite rounding errors.
    """
    around = F.array(*[F.lit(i).cast("bigint") for i in (-1, 0, 1)])
    near = stations.select(
        F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), _cell("lat", degrees).alias("_y"), _cell("lon", degrees).alias("_x"),
    ).withColumn("_dy", F.explode(around)).withColumn("_dx", F.explode(around)).select(
        "_lat", "_lon", (F.col("_y") + F.col("_dy")).alias("_y"), F.pmod(F.col("_x") + F.col("_dx"), _columns(degrees)).alias("_x"),
    ).distinct()  # three columns or fewer around the globe meet themselves
    placed = sites.withColumns({"_y": _cell("lat", degrees), "_x": F.pmod(_cell("lon", degrees), _columns(degrees))})
    measured = with_distance_m(placed.join(near, ["_y", "_x"]), "metres", "lat", "lon", "_lat", "_lon")
    listed = measured.select("lat", "lon", "_lat", "_lon", F.round(F.col("metres") * 10_000).cast("bigint").alias("far"))
    if most is not None:
        # The radius is looked at behind the window, so the distance is computed in one place.
        listed = listed.withColumn("_rank", F.rank().over(W.partitionBy("lat", "lon").orderBy("far")))
        listed = listed.where((F.col("_rank") <= most) & (F.col("far") < _safe_radius(degrees) * 10_000))
    return listed.select("lat", "lon", "_lat", "_lon", "far")


def nearest_reporting(sites: DataFrame, stations: DataFrame) -> DataFrame:
    """Nearest station per site position and day.

    ``sites`` has ``Date, lat, lon``, ``stations`` has ``Date, code, lat, lon``,
    one row per reporting day or more. Gives ``Date, lat, lon, code, metres``;
    equal distances go to the smaller code, stations without a code count as
    none. Days without stations and positions with a missing coordinate have no row.
    """

    def located(df):
        return df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())

    # Stations at one point are the same candidate; the smallest code stands for them.
    active = located(stations).where(F.col("code").isNotNull()).groupBy("Date", "lat", "lon").agg(F.min("code").alias("code"))
    active = stage(active.select("Date", "code", F.col("lat").alias("_lat"), F.col("lon").alias("_lon")), "station-days")
    points = stage(active.select(F.col("_lat").alias("lat"), F.col("_lon").alias("lon")).distinct(), "station-positions")
    wanted = stage(located(sites).select("Date", "lat", "lon").distinct().join(active.select("Date").distinct(), "Date", "left_semi"), "site-days")

    done = []
    sizes = [*CELL_DEGREES[_first_size(points):-1:2], CELL_DEGREES[-1]]
    for i, degrees in enumerate(sizes):
        last = i == len(sizes) - 1
        # Sites without a candidate on this grid go on at once.
        listed = stage(_candidates(wanted.select("lat", "lon").distinct(), points, degrees, None if last else CANDIDATES << 2 * i), "candidates")
        reporting = wanted.join(listed, ["lat", "lon"]).join(active, ["Date", "_lat", "_lon"])
        found = reporting.groupBy("Date", "lat", "lon").agg(F.min(F.struct("far", "code")).alias("best"))
        done.append(stage(found, "nearest"))
        if last:
            break
        wanted = stage(wanted.join(done[-1], ["Date", "lat", "lon"], "left_anti"), "site-days")
        if wanted.isEmpty():
            break
    return union_aligned(*done).select("Date", "lat", "lon", F.col("best.code").alias("code"), (F.col("best.far") / 10_000).alias("metres"))


def closest_station_each_day(indoor: DataFrame, outdoor: DataFrame) -> DataFrame:
    """Distinct site positions with ``closest_station`` and ``km_distance_to_station``."""
    sites = indoor.select("Date", F.col("SchoolLatitude").alias("lat"), F.col("SchoolLongitude").alias("lon"))
    stations = outdoor.select("Date", "code", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return nearest_reporting(sites, stations).select(
        "Date", F.col("lat").alias("SchoolLatitude"), F.col("lon").alias("SchoolLongitude"),
        F.col("code").alias("closest_station"), (F.col("metres") / 1000).alias("km_distance_to_station"),
    )


def link_outdoor(indoor: DataFrame, outdoor: DataFrame, closest: DataFrame | None = None, suffix: str = "_out") -> DataFrame:
    """Each indoor row with the reading of the day's closest station at that time.

    Rows without coordinates and days without any station vanish; a station
    without a reading at the time leaves NULLs. Outdoor columns whose name is
    taken get ``suffix``. ``closest`` may hold the pairing of a larger table.
    """
    if closest is None:
        closest = closest_station_each_day(indoor, outdoor)
    paired = indoor.join(closest, ["Date", "SchoolLatitude", "SchoolLongitude"])
    paired = paired.select(*indoor.columns, "closest_station", "km_distance_to_station")
    keys = {"code": "closest_station", "DateTime": "DateTime", "Date": "Date"}
    taken = set(paired.columns)
    right = outdoor.select(*[
        F.col(c).alias(f"_k_{c}") if c in keys else F.col(c).alias(c + suffix if c in taken else c) for c in outdoor.columns
    ])
    on = [paired[v] == right[f"_k_{k}"] for k, v in keys.items()]
    return paired.join(right, on, "left").drop(*[f"_k_{k}" for k in keys])
