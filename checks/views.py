"""The operators' inputs, derived from whole test tables: in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airq.functions.geo import EQUATOR_M, FLATTENING

READING_MEASURES = ("rco2", "pm02", "atmp")
EVENT_TYPES = ("signup", "purchase", "view", "click", "error")
HOLIDAYS = ["2024-01-15"]
TERMS = [("autumn", "2024-01-03", "2024-01-12"), ("spring", "2024-01-22", "2024-01-26")]


_SCHEMAS: dict = {}


class Tables:
    """The test tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def readings_long(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("reading_id"), "ts", F.col("user_id").alias("device_id"),
            F.col("event_type").alias("field"), "value")

    def readings(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("reading_id"), F.col("user_id").alias("device_id"), F.col("ts").alias("DateTime"),
            F.to_date("ts").alias("Date"), (F.col("value") * 10 + 412).alias("rco2"),
            F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("pm02"), (F.col("value") / 10).alias("atmp"))

    def sites(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("SchoolId_short"), key.alias("device_id"), key.cast("string").alias("SchoolId_long"),
            (50.0 + (key * 37 % 800) / 100.0).alias("SchoolLatitude"), (-5.0 + (key * 91 % 600) / 100.0).alias("SchoolLongitude"),
            (F.col("c_nationkey") % 3).alias("MonitoringType"), F.col("c_nationkey").alias("SchoolType"))

    def stations(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("code"), F.col("s_name").alias("site"), (50.0 + (key * 53 % 800) / 100.0).alias("latitude"),
            (-5.0 + (key * 29 % 600) / 100.0).alias("longitude"), (F.col("s_nationkey") % 4).alias("site_type"))

    def outdoor(self) -> DataFrame:
        """Hourly means of the stations, one per supplier; a third of the values is missing."""
        n = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        value = F.when(F.col("event_id") % 5 != 0, F.col("value"))
        return self.table("events").groupBy(
            (F.col("event_id") * 7 % n).alias("code"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("DateTime"), F.to_date("ts").alias("Date"),
        ).agg(F.avg(value).alias("pm2_5"))

    def outdoor_located(self) -> DataFrame:
        return self.outdoor().join(self.stations(), "code")

    def terms(self) -> DataFrame:
        rows = self.spark.createDataFrame(TERMS, "term_name string, start_date string, end_date string")
        return rows.withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date")})

    def holidays(self) -> DataFrame:
        return self.spark.createDataFrame([(h,) for h in HOLIDAYS], "date string").withColumn("date", F.col("date").cast("date"))

    def shipments(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("SchoolId_short"), F.col("l_shipdate").alias("DateTime"), F.col("l_quantity").alias("pm02"),
            F.when(F.col("l_linenumber") != 3, F.col("l_discount") * 100).alias("pm2_5"))


def sql_distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The ellipsoidal distance as select items, of which ``metres`` is the last."""
    return f"""{FLATTENING!r}::DOUBLE AS f_, (atan((1 - f_) * tan(radians({lat1}))) + atan((1 - f_) * tan(radians({lat2})))) / 2 AS mid_,
        (atan((1 - f_) * tan(radians({lat2}))) - atan((1 - f_) * tan(radians({lat1})))) / 2 AS half_,
        (radians({lon2}) - radians({lon1})) / 2 AS across_,
        sin(half_) ** 2 + (cos(mid_) ** 2 - sin(half_) ** 2) * sin(across_) ** 2 AS h_, 2 * asin(sqrt(least(greatest(h_, 0), 1))) AS arc_,
        arc_ / nullif(sin(arc_), 0) AS t_, 2 * (sin(mid_) * cos(half_)) ** 2 / nullif(1 - h_, 0) AS u_,
        2 * (sin(half_) * cos(mid_)) ** 2 / nullif(h_, 0) AS v_, u_ + v_ AS x_, u_ - v_ AS y_, 4 * t_ ** 2 AS d_, 2 * cos(arc_) AS e_,
        f_ * (t_ * x_ - y_) / 4 AS first_,
        f_ ** 2 / 64 * (x_ * (d_ * e_ + (t_ - (d_ * e_ - e_) / 2) * x_) - y_ * (2 * d_ + e_ * y_) + d_ * x_ * y_) AS second_,
        CASE WHEN h_ <= 0 THEN 0 ELSE {EQUATOR_M!r}::DOUBLE * sin(arc_) * (t_ - first_ + second_) END AS metres"""


def _four(c: str) -> str:
    return (
        f"avg({c}) AS {c}_mean, quantile_cont({c}, 0.5) AS {c}_median, "
        f"quantile_cont({c}, 0.25) AS {c}_q25, quantile_cont({c}, 0.75) AS {c}_q75"
    )


def sql_four(*measures: str) -> str:
    return ", ".join(_four(c) for c in measures)


VIEWS = {
    "readings_long": "SELECT event_id AS reading_id, ts, user_id AS device_id, event_type AS field, value FROM events",
    "readings": """SELECT event_id AS reading_id, user_id AS device_id, ts AS "DateTime", CAST(ts AS DATE) AS "Date",
        value * 10 + 412 AS rco2, CASE WHEN event_id % 7 <> 0 THEN value END AS pm02, value / 10 AS atmp FROM events""",
    "sites": """SELECT c_custkey AS SchoolId_short, c_custkey AS device_id, CAST(c_custkey AS VARCHAR) AS SchoolId_long,
        50.0::DOUBLE + (c_custkey * 37 % 800) / 100.0::DOUBLE AS SchoolLatitude,
        -5.0::DOUBLE + (c_custkey * 91 % 600) / 100.0::DOUBLE AS SchoolLongitude,
        c_nationkey % 3 AS MonitoringType, c_nationkey AS SchoolType FROM customer""",
    "stations": """SELECT s_suppkey AS code, s_name AS site, 50.0::DOUBLE + (s_suppkey * 53 % 800) / 100.0::DOUBLE AS latitude,
        -5.0::DOUBLE + (s_suppkey * 29 % 600) / 100.0::DOUBLE AS longitude, s_nationkey % 4 AS site_type FROM supplier""",
    "outdoor": """SELECT event_id * 7 % (SELECT count(*) FROM supplier) AS code, date_trunc('hour', ts) AS "DateTime",
        CAST(ts AS DATE) AS "Date", avg(CASE WHEN event_id % 5 <> 0 THEN value END) AS pm2_5 FROM events GROUP BY ALL""",
    "outdoor_located": "SELECT o.*, s.site, s.latitude, s.longitude, s.site_type FROM outdoor o JOIN stations s ON o.code = s.code",
    "open_days": f"""SELECT d AS "Date" FROM (SELECT DISTINCT CAST(unnest(generate_series(a, b + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (VALUES {", ".join(f"(DATE '{a}', DATE '{b}')" for _, a, b in TERMS)}) t(a, b))
        WHERE dayofweek(d) NOT IN (0, 6) AND d NOT IN ({", ".join(f"DATE '{h}'" for h in HOLIDAYS)})""",
    "hourly": """SELECT date_trunc('hour', "DateTime") AS "DateTime", device_id, avg(rco2) AS rco2, avg(pm02) AS pm02,
        avg(atmp) AS atmp, any_value("Date") AS "Date" FROM readings GROUP BY 1, 2""",
    "hourly_sites": """SELECT h.*, s.SchoolId_short, s.SchoolLatitude, s.SchoolLongitude
        FROM hourly h LEFT JOIN sites s ON h.device_id = s.device_id""",
    "nearest": f"""SELECT * EXCLUDE (place) REPLACE (round(metres, 4) AS metres) FROM (SELECT *, row_number() OVER (
            PARTITION BY "Date", SchoolLatitude, SchoolLongitude ORDER BY round(metres, 4), code) AS place
        FROM (SELECT p.*, o.code, {sql_distance("p.SchoolLatitude", "p.SchoolLongitude", "o.latitude", "o.longitude")}
            FROM (SELECT DISTINCT "Date", SchoolLatitude, SchoolLongitude FROM hourly_sites WHERE SchoolLatitude IS NOT NULL) p
            JOIN (SELECT DISTINCT "Date", code, latitude, longitude FROM outdoor_located) o ON p."Date" = o."Date"))
        WHERE place = 1""",
    "in_out": """SELECT h.*, n.code AS closest_station, n.metres / 1000 AS km_distance_to_station,
            o.pm2_5, o.site, o.latitude, o.longitude, o.site_type
        FROM hourly_sites h JOIN nearest n USING ("Date", SchoolLatitude, SchoolLongitude)
        LEFT JOIN outdoor_located o ON o.code = n.code AND o."DateTime" = h."DateTime" AND o."Date" = h."Date\"""",
    "shipments": """SELECT l_suppkey AS SchoolId_short, l_shipdate AS "DateTime", l_quantity AS pm02,
        CASE WHEN l_linenumber <> 3 THEN l_discount * 100 END AS pm2_5 FROM lineitem""",
    # Readings that pass the scaled day rules, then the gradient rule.
    "judged": """SELECT * FROM readings WHERE (device_id, "Date") IN (SELECT (device_id, "Date") FROM (
        SELECT device_id, "Date", count(*) AS n, CASE WHEN count(pm02) = count(*) THEN max(pm02) END AS top_pm,
            CASE WHEN count(rco2) = count(*) THEN max(rco2) END AS top_co2,
            count(*) FILTER (WHERE hour("DateTime") BETWEEN 9 AND 15) AS n_in,
            avg(rco2) FILTER (WHERE hour("DateTime") BETWEEN 9 AND 15) AS co2_in
        FROM readings GROUP BY 1, 2) WHERE n > 2 AND NOT coalesce(top_pm > 100 OR top_co2 > 3000, false) AND n_in > 1 AND co2_in > 480)""",
    "smoothed": """SELECT *, CASE WHEN count(rco2) OVER f = 2 THEN avg(rco2) OVER f END AS smooth FROM judged
        WINDOW f AS (PARTITION BY device_id, "Date" ORDER BY "DateTime", reading_id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)""",
    "graded": """SELECT *, lead(smooth) OVER w - lag(smooth) OVER w AS gradient FROM smoothed
        WINDOW w AS (PARTITION BY device_id, "Date" ORDER BY "DateTime", reading_id)""",
    "minutes": """SELECT * FROM judged WHERE (device_id, "Date") IN (SELECT (device_id, "Date") FROM graded
        WHERE hour("DateTime") BETWEEN 9 AND 15 AND gradient > 10)""",
    "school_minutes": """SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY device_id, "Date") AS n FROM minutes)
        WHERE n > 3 AND hour("DateTime") BETWEEN 9 AND 15 AND "Date" IN (SELECT "Date" FROM open_days)""",
}


def with_views(sql: str) -> str:
    """``sql`` preceded by the views it mentions, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").replace(";", " ").split())
        for name, body in VIEWS.items():
            if name in words and name not in needed:
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ", ".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    if "{views}" in sql:
        return sql.replace("{views}", ctes)
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes}, {sql.lstrip()[5:]}"
    return f"WITH {ctes} {sql}"
