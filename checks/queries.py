"""One query per operator family, with the SQL for the same result.

Each query names its output columns with a kind: i whole number, f number,
s text, b truth value, d date, t time. Both sides pass their result through the
same presentation: dates and times as text, numbers to six digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from airq.functions import times
from airq.functions.aggregates import n_rows
from airq.functions.geo import with_distance_m
from airq.functions.text import clean_postcode, date_device, format_postcode, postcode_area, to_int
from airq.operators import lookup as L
from airq.operators import quality as Q
from airq.operators import rollup as R
from airq.operators import stats as S
from airq.operators.align import union_aligned
from airq.operators.calendars import school_days
from airq.operators.nearest import closest_station_each_day, link_outdoor
from airq.operators.ventilation import by_ventilation, ventilation, with_running_integral
from airq.plans import outdoor as outdoor_plan
from airq.plans import reports, schools
from airq.plans.indoor import CleaningRules, indoor_minutes, school_hour_minutes
from airq.sources import outputs, series, slices, tables
from airq.sources.staging import scratch_path
from checks.views import EVENT_TYPES, READING_MEASURES, Tables, sql_distance, sql_four, with_views

ORDER = ("DateTime", "reading_id")

# Means of few decimals often end in exactly half a unit of the sixth digit,
# where the last bit of a sum would decide; moved off that point, they round alike.
NUDGE = 1.7e-7
RULES = CleaningRules(
    complete_day=Q.Completeness(2), complete_school_day=Q.Completeness(3), extremes={"pm02": 100, "rco2": 3000},
    occupancy=Q.Occupancy(rows=1), gradient=10, smooth_rows=2, reach_rows=1, measures=READING_MEASURES, order=ORDER,
    one_row_per_minute=False,
)


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    columns: str
    sql: str | None = None

    def fields(self) -> list[tuple[str, str]]:
        return [tuple(c.split(":")) for c in self.columns.split()]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        show = {
            "i": lambda c: c.cast("bigint"),
            "f": lambda c: F.round(c.cast("double") + F.lit(NUDGE), 6),
            "s": lambda c: c.cast("string"),
            "b": lambda c: c,
            "d": lambda c: F.date_format(c, "yyyy-MM-dd"),
            "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        }
        df = self.build(Tables(spark, folder))
        return df.select(*[show[kind](F.col(name)).alias(name) for name, kind in self.fields()])

    def oracle(self) -> str:
        show = {
            "i": 'CAST("{0}" AS BIGINT)',
            "f": f'round(CAST("{{0}}" AS DOUBLE) + {NUDGE}::DOUBLE, 6)',
            "s": 'CAST("{0}" AS VARCHAR)',
            "b": '"{0}"',
            "d": "strftime(\"{0}\", '%Y-%m-%d')",
            "t": "strftime(\"{0}\", '%Y-%m-%d %H:%M:%S.%f')",
        }
        shown = ", ".join(f'{show[kind].format(name)} AS "{name}"' for name, kind in self.fields())
        return f"SELECT {shown} FROM ({with_views(self.sql)}) q"


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = Query(build, columns, sql)
        return build
    return register


FOUR = " ".join(f"{m}_{s}:f" for m in READING_MEASURES for s in ("mean", "median", "q25", "q75"))
THREE = " ".join(f"{m}:f" for m in READING_MEASURES)


# Sources -----------------------------------------------------------------

@query(
    "range_scan_pivot", "DateTime:t device_id:i " + " ".join(f"{e}:f" for e in EVENT_TYPES),
    "SELECT date_trunc('hour', ts) AS \"DateTime\", device_id, "
    + ", ".join(f"avg(value) FILTER (WHERE field = '{e}') AS {e}" for e in EVENT_TYPES)
    + " FROM readings_long WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY 1, 2",
)
def range_scan_pivot(t: Tables):
    return series.read_series(t.readings_long(), "2024-01-01", "2024-02-01", "1 hour", EVENT_TYPES)


@query(
    "range_scan_days", "DateTime:t device_id:i click:f view:f",
    """SELECT date_trunc('hour', ts) AS "DateTime", device_id, avg(value) FILTER (WHERE field = 'click') AS click, avg(value) FILTER (WHERE field = 'view') AS view
        FROM readings_long WHERE ts >= TIMESTAMP '2024-01-09 06:30:00' AND ts < TIMESTAMP '2024-01-17' AND field IN ('click', 'view') GROUP BY 1, 2""",
)
def range_scan_days(t: Tables):
    """A range within the data: rows on either side and of other fields stay out."""
    return series.read_series(t.readings_long(), "2024-01-09 06:30:00", "2024-01-17", "1 hour", ("click", "view"))


@query(
    "outdoor_years", "code:i date:t pm2_5:f n:i",
    """SELECT l_suppkey AS code, l_shipdate AS date, sum(l_quantity) AS pm2_5, count(*) AS n FROM lineitem WHERE year(l_shipdate) IN (1996, 1999)
        AND l_suppkey IN (SELECT code FROM stations WHERE site_type NOT IN (1, 2) OR site_type IS NULL) GROUP BY 1, 2""",
)
def outdoor_years(t: Tables):
    """Two of seven years, with others between them."""
    hourly = t.table("lineitem").select(F.col("l_suppkey").alias("code"), F.col("l_shipdate").alias("date"), F.col("l_quantity").alias("pm2_5"))
    kept = series.station_readings(hourly, series.background_stations(t.stations(), [1, 2]), years=[1999, 1996])
    return kept.groupBy("code", "date").agg(F.sum("pm2_5").alias("pm2_5"), n_rows().alias("n"))


@query(
    "months_written", "year:i month:i n:i total:f written_first:i written_again:i",
    """SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS n, sum(l_quantity) AS total, 3 AS written_first, 1 AS written_again
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-11-01' AND l_shipdate < TIMESTAMP '1997-03-01' GROUP BY 1, 2""",
)
def months_written(t: Tables):
    """Three months across a year's end, then a fourth; all other months stay out."""
    root, lines = scratch_path(t.spark, "months"), t.table("lineitem").select("l_shipdate", "l_quantity")

    def make(month: date, keep):
        stop = date(month.year + month.month // 12, month.month % 12 + 1, 1)
        return {"lines": series.in_range(lines, str(month), str(stop), time="l_shipdate")}

    months = [date(1996, 11, 1), date(1996, 12, 1), date(1997, 1, 1)]
    first = outputs.write_months(t.spark, root, months, make)
    again = outputs.write_months(t.spark, root, [*months, date(1997, 2, 1)], make)
    back = outputs.read_months(t.spark, root, ["lines"])["lines"]
    return back.groupBy("year", "month").agg(n_rows().alias("n"), F.sum("l_quantity").alias("total")).withColumns(
        {"written_first": F.lit(len(first)), "written_again": F.lit(len(again))})


@query(
    "time_slices", "step:s slice_start:t slice_end:t n:i",
    "WITH span AS (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS low, max(ts) AS high FROM events), "
    + ", ".join(
        f"s{i} AS (SELECT '{step}' AS step, unnest(generate_series(low, high, INTERVAL '{step}')) AS slice_start, "
        f"INTERVAL '{step}' AS width, high FROM span)" for i, step in enumerate(("10 minutes", "1 day", "1 month")))
    + ", cut AS (SELECT step, slice_start, slice_start + width AS slice_end FROM "
    "(SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2) WHERE slice_start <= high), "
    "held AS (SELECT '10 minutes' AS step, time_bucket(INTERVAL '10 minutes', ts) AS slice_start, count(*) AS n FROM events GROUP BY ALL "
    "UNION ALL SELECT '1 day', date_trunc('day', ts), count(*) FROM events GROUP BY ALL "
    "UNION ALL SELECT '1 month', date_trunc('month', ts), count(*) FROM events GROUP BY ALL) "
    "SELECT cut.*, coalesce(n, 0) AS n FROM cut LEFT JOIN held ON held.step = cut.step AND held.slice_start = cut.slice_start",
)
def time_slices(t: Tables):
    events = t.table("events").select("ts")
    floors = {
        "10 minutes": F.window("ts", "10 minutes").start,
        "1 day": F.date_trunc("day", "ts").cast("timestamp_ntz"),
        "1 month": F.date_trunc("month", "ts").cast("timestamp_ntz"),
    }
    parts = []
    for step, start in floors.items():
        held = events.groupBy(start.alias("slice_start")).agg(n_rows().alias("n"))
        cut = slices.slices_of(events, step).withColumn("step", F.lit(step))
        parts.append(cut.join(held, "slice_start", "left").withColumn("n", F.coalesce("n", F.lit(0))))
    return union_aligned(*parts)


@query(
    "cast_projection", "p_partkey:i p_size:s p_retailprice:s brand_no:i name_no:i",
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice,
        TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no, TRY_CAST(p_name AS INTEGER) AS name_no FROM part""",
)
def cast_projection(t: Tables):
    columns = ["p_partkey", "p_size", "p_retailprice", "p_brand", "p_name"]
    df = tables.read_columns(t.spark, f"{t.folder}/part.parquet", columns, as_text=["p_size", "p_retailprice"])
    return df.withColumns({"brand_no": to_int(F.expr("substring(p_brand, 7)")), "name_no": to_int("p_name")})


@query(
    "table_scan", "c_custkey:i c_name:s c_nationkey:i c_acctbal:f c_mktsegment:s",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def table_scan(t: Tables):
    return tables.read_table(t.spark, f"{t.folder}/customer.parquet")


@query(
    "csv_scan", "order:i placed:d status:s total:f number:i segment:s",
    """SELECT o_orderkey AS "order", o_orderdate AS placed, nullif(o_orderstatus, 'P') AS status, o_totalprice AS total,
        TRY_CAST(o_orderpriority AS INTEGER) AS number, NULL AS segment FROM orders""",
)
def csv_scan(t: Tables):
    path = scratch_path(t.spark, "csv")
    written = t.table("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order.date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("NA").alias("Status (now)"),
        "o_totalprice", "o_orderpriority", F.lit(" ").alias("blank"))
    written.write.csv(path, header=True)
    return tables.read_csv(t.spark, path, {
        "order": ("o_orderkey", "bigint"), "placed": ("order.date", "date"), "status": ("Status..now.", "string"),
        "total": ("o_totalprice", "double"), "number": ("o_orderpriority", "int"), "segment": ("blank", "string"),
    }, pattern="*.csv", recursive=True)


@query(
    "outdoor_scan", "code:i DateTime:t pm2_5:f",
    """SELECT o.code, o."DateTime", o.pm2_5 FROM outdoor o WHERE year(o."DateTime") = 2024
        AND o.code IN (SELECT code FROM stations WHERE site_type NOT IN (1, 2) OR site_type IS NULL)""",
)
def outdoor_scan(t: Tables):
    return series.station_readings(
        t.outdoor(), series.background_stations(t.stations(), [1, 2]), years=[2024], time="DateTime")


@query(
    "resumable_write", "month:i device_id:i n:i total:f written_first:i written_again:i",
    """SELECT month("DateTime") AS month, device_id, count(*) AS n, sum(rco2) AS total, 2 AS written_first, 0 AS written_again
        FROM readings GROUP BY 1, 2""",
)
def resumable_write(t: Tables):
    root = scratch_path(t.spark, "months")
    readings = t.readings()

    def make(month: date, keep):
        stop = date(month.year + month.month // 12, month.month % 12 + 1, 1)
        return {"readings": series.in_range(readings, str(month), str(stop), time="DateTime")}

    months = [date(2024, 1, 1), date(2024, 2, 1)]
    first = outputs.write_months(t.spark, root, months, make)
    again = outputs.write_months(t.spark, root, months, make)
    back = outputs.read_months(t.spark, root, ["readings"])["readings"]
    return back.groupBy("month", "device_id").agg(n_rows().alias("n"), F.sum("rco2").alias("total")).withColumns(
        {"written_first": F.lit(len(first)), "written_again": F.lit(len(again))})


@query(
    "snapshot_roundtrip", "name:s n:i",
    "SELECT 'readings' AS name, count(*) AS n FROM readings UNION ALL SELECT 'outdoor', count(*) FROM outdoor",
)
def snapshot_roundtrip(t: Tables):
    root = scratch_path(t.spark, "snapshot")
    outputs.write_snapshot({"readings": t.readings(), "outdoor": t.outdoor()}, root)
    back = outputs.read_snapshot(t.spark, root, ["readings", "outdoor"])
    return union_aligned(*[df.agg(n_rows().alias("n")).withColumn("name", F.lit(name)) for name, df in back.items()])


# Day rules ---------------------------------------------------------------

def _complete_days(rule: Q.Completeness, t: Tables):
    return Q.keep_where(t.readings(), Q.complete(rule))


for _name, _rule in {
    "complete_days_minutely_24h": Q.Completeness(4),
    "complete_days_hourly_24h": Q.Completeness(3, at_least=True),
    "complete_days_minutely_school": Q.Completeness(2),
    "complete_days_m15_school": Q.Completeness(2, at_least=True),
    "complete_days_hourly_school": Q.Completeness(1),
}.items():
    QUERIES[_name] = Query(
        partial(_complete_days, _rule), "reading_id:i device_id:i Date:d rco2:f",
        'SELECT * FROM readings QUALIFY count(*) OVER (PARTITION BY device_id, "Date") '
        + (">= " if _rule.at_least else "> ") + str(_rule.rows),
    )


@query(
    "missing_ratio_filter", "code:i DateTime:t Date:d pm2_5:f",
    """SELECT * FROM outdoor QUALIFY avg(CASE WHEN pm2_5 IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY code, "Date") <= 0.25""",
)
def missing_ratio_filter(t: Tables):
    return Q.keep_where(t.outdoor(), Q.mostly_present("pm2_5"), keys=("Date", "code"))


@query(
    "outdoor_clean", "code:i DateTime:t LocalTime:t Date:d DateCode:s pm2_5:f site:s latitude:f longitude:f",
    """SELECT o.code, o."DateTime", o."DateTime" AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/London' AS "LocalTime", o."Date",
        strftime(o."Date", '%Y-%m-%d') || CAST(o.code AS VARCHAR) AS "DateCode", o.pm2_5, o.site, o.latitude, o.longitude
        FROM (SELECT * FROM outdoor_located WHERE site_type NOT IN (1, 2)
            WINDOW w AS (PARTITION BY code, "Date")
            QUALIFY count(*) OVER w >= 3 AND avg(CASE WHEN pm2_5 IS NULL THEN 1 ELSE 0 END) OVER w <= 0.25) o""",
)
def outdoor_clean(t: Tables):
    return outdoor_plan.outdoor_clean(
        t.outdoor().drop("Date"), t.stations(), years=[2024], time="DateTime", rule=Q.Completeness(3, at_least=True), excluded=[1, 2])


@query(
    "extreme_days_removed", "reading_id:i device_id:i Date:d pm02:f",
    """SELECT r.* FROM readings r ANTI JOIN (SELECT device_id, "Date" FROM readings GROUP BY 1, 2
        HAVING (count(pm02) = count(*) AND max(pm02) > 100) OR max(rco2) > 2000) b
        ON r.device_id = b.device_id AND r."Date" = b."Date\"""",
)
def extreme_days_removed(t: Tables):
    df = t.readings()
    return Q.drop_days(df, Q.days_where(df, ~Q.plausible({"pm02": 100, "rco2": 2000})))


@query(
    "occupied_days", "reading_id:i device_id:i Date:d rco2:f",
    """SELECT r.* FROM readings r SEMI JOIN (SELECT device_id, "Date" FROM readings
        WHERE hour("DateTime") BETWEEN 9 AND 15 GROUP BY 1, 2
        HAVING count(*) > 1 AND CASE WHEN count(pm02) = count(*) THEN avg(pm02) END > 20) g
        ON r.device_id = g.device_id AND r."Date" = g."Date\"""",
)
def occupied_days(t: Tables):
    # pm02 stands in for CO2: it has missing values, which the strict mean must notice.
    swapped = t.readings().withColumnsRenamed({"rco2": "co2", "pm02": "rco2"})
    return Q.keep_where(swapped, Q.occupied(Q.Occupancy(rows=1, mean_co2=20))).withColumnsRenamed({"rco2": "pm02", "co2": "rco2"})


_GRADIENT = """WITH smooth AS (SELECT *, CASE WHEN count({c}) OVER f = 2 THEN avg({c}) OVER f END AS s FROM readings
        WINDOW f AS (PARTITION BY device_id, "Date" ORDER BY "DateTime", reading_id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
    steep AS (SELECT *, lead(s) OVER w - lag(s) OVER w AS gradient FROM smooth
        WINDOW w AS (PARTITION BY device_id, "Date" ORDER BY "DateTime", reading_id)) """


@query(
    "co2_gradient_days", "device_id:i Date:d",
    _GRADIENT.format(c="rco2")
    + """SELECT DISTINCT device_id, "Date" FROM steep WHERE hour("DateTime") BETWEEN 9 AND 15 AND gradient > 100""",
)
def co2_gradient_days(t: Tables):
    return Q.gradient_days(t.readings(), 100, k=2, reach=1, order=ORDER)


@query(
    "co2_gradient", "reading_id:i device_id:i Date:d co2_gradient:f",
    _GRADIENT.format(c="pm02") + "SELECT *, gradient AS co2_gradient FROM steep",
)
def co2_gradient(t: Tables):
    return Q.with_co2_gradient(t.readings().drop("rco2").withColumnRenamed("pm02", "rco2"), k=2, reach=1, order=ORDER)


@query(
    "co2_step_days", "device_id:i Date:d",
    """SELECT DISTINCT device_id, "Date" FROM (SELECT *, lag(rco2) OVER (PARTITION BY device_id ORDER BY "DateTime", reading_id)
        - rco2 AS step FROM readings) WHERE hour("DateTime") BETWEEN 9 AND 15 AND step > 200""",
)
def co2_step_days(t: Tables):
    return Q.step_days(t.readings(), 200, order=ORDER)


@query(
    "clean_co2_quarters", "reading_id:i device_id:i Date:d rco2:f",
    """WITH kept AS (SELECT r.* FROM readings r SEMI JOIN (SELECT device_id, "Date" FROM readings
            WHERE hour("DateTime") BETWEEN 9 AND 15 GROUP BY 1, 2 HAVING count(*) > 1 AND avg(rco2) > 480) g
            ON r.device_id = g.device_id AND r."Date" = g."Date"),
        steps AS (SELECT *, lag(rco2) OVER (PARTITION BY device_id ORDER BY "DateTime", reading_id) - rco2 AS step FROM kept)
    SELECT k.* FROM kept k SEMI JOIN (SELECT * FROM steps WHERE hour("DateTime") BETWEEN 9 AND 15 AND step > 200) s
        ON k.device_id = s.device_id AND k."Date" = s."Date\"""",
)
def clean_co2_quarters(t: Tables):
    return Q.clean_co2_quarters(t.readings(), Q.Occupancy(rows=1, skip_missing=True), order=ORDER)


@query("indoor_minutes", "reading_id:i device_id:i Date:d rco2:f", "SELECT * FROM minutes")
def clean_minutes(t: Tables):
    return indoor_minutes(t.readings(), rules=RULES)


# Few devices with many readings: all events of a fifth of the users are one device's, three kinds of them its CO2.
def _dense_long(t: Tables) -> DataFrame:
    co2 = F.col("field").isin("view", "click", "error")
    return t.readings_long().select(
        "ts", (F.col("device_id") % 5).alias("device_id"), F.when(co2, "rco2").when(F.col("field") == "signup", "pm02").otherwise("atmp").alias("field"),
        F.when(co2, F.col("value") * 10 + 412).otherwise(F.col("value")).alias("value"))


_DENSE_RULES = CleaningRules(
    complete_day=Q.Completeness(4), extremes={"rco2": 2500, "pm02": 300}, occupancy=Q.Occupancy(rows=1, skip_missing=True), gradient=10,
    smooth_rows=2, reach_rows=1, measures=READING_MEASURES)


@query(
    "indoor_minutes_from_long", "DateTime:t device_id:i Date:d DateDevice:s " + THREE,
    """WITH wide AS (SELECT time_bucket(INTERVAL '2 hours', ts) AS "DateTime", user_id % 5 AS device_id,
            avg(value * 10 + 412) FILTER (WHERE event_type IN ('view', 'click', 'error')) AS rco2,
            avg(value) FILTER (WHERE event_type = 'signup') AS pm02, avg(value) FILTER (WHERE event_type = 'purchase') AS atmp
        FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25 12:00:00' GROUP BY 1, 2),
    own AS (SELECT *, CAST("DateTime" AS DATE) AS "Date" FROM wide WHERE device_id IN (SELECT device_id FROM sites WHERE MonitoringType IN (0, 1))),
    verdict AS (SELECT device_id, "Date" FROM own GROUP BY ALL HAVING count(*) > 4
        AND NOT coalesce(CASE WHEN count(rco2) = count(*) THEN max(rco2) END > 2500, false)
        AND NOT coalesce(CASE WHEN count(pm02) = count(*) THEN max(pm02) END > 300, false)
        AND count(*) FILTER (WHERE hour("DateTime") BETWEEN 9 AND 15) > 1 AND avg(rco2) FILTER (WHERE hour("DateTime") BETWEEN 9 AND 15) > 480),
    kept AS (SELECT own.* FROM own SEMI JOIN verdict v ON own.device_id = v.device_id AND own."Date" = v."Date"),
    smooth AS (SELECT *, CASE WHEN count(rco2) OVER f = 2 THEN avg(rco2) OVER f END AS level FROM kept
        WINDOW f AS (PARTITION BY device_id, "Date" ORDER BY "DateTime" ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
    climbs AS (SELECT *, lead(level) OVER w - lag(level) OVER w AS gradient FROM smooth WINDOW w AS (PARTITION BY device_id, "Date" ORDER BY "DateTime"))
    SELECT *, CAST("Date" AS VARCHAR) || ' ' || CAST(device_id AS VARCHAR) AS "DateDevice" FROM kept WHERE (device_id, "Date") IN
        (SELECT (device_id, "Date") FROM climbs WHERE hour("DateTime") BETWEEN 9 AND 15 AND gradient > 10)""",
)
def clean_minutes_from_long(t: Tables):
    """The whole chain: a range of the long readings, window means, devices of two kinds of schools, all day rules."""
    wide = series.read_series(_dense_long(t), "2024-01-05", "2024-01-25 12:00:00", "2 hours", READING_MEASURES)
    devices = union_aligned(*[L.devices_of_type(_schools(t), _school_devices(t), kind) for kind in (0, 1)])
    return indoor_minutes(wide, devices, _DENSE_RULES)


@query("school_hour_minutes", "reading_id:i device_id:i Date:d rco2:f", "SELECT * FROM school_minutes")
def clean_school_minutes(t: Tables):
    return school_hour_minutes(indoor_minutes(t.readings(), rules=RULES), t.terms(), t.holidays(), RULES)


@query(
    "school_days", "reading_id:i device_id:i DateTime:t",
    """SELECT r.* FROM readings r SEMI JOIN open_days d ON r."Date" = d."Date" WHERE hour("DateTime") BETWEEN 9 AND 15""",
)
def school_day_readings(t: Tables):
    return school_days(t.readings(), t.terms(), t.holidays())


# Devices -----------------------------------------------------------------

def _schools(t: Tables):
    return t.sites().select("SchoolId_short", "SchoolId_long", "MonitoringType")


def _school_devices(t: Tables):
    return t.sites().select("SchoolId_long", F.col("device_id").alias("MonitorReferenceId"))


def _devices(kind: int | None, t: Tables):
    return L.keep_devices(t.readings(), L.devices_of_type(_schools(t), _school_devices(t), kind))


for _name, _kind, _where in (
    ("single_monitor", 1, "WHERE MonitoringType = 1"), ("multi_monitor", 2, "WHERE MonitoringType = 2"), ("school_monitors", None, "")):
    QUERIES[_name] = Query(
        partial(_devices, _kind), "reading_id:i device_id:i",
        f"SELECT * FROM readings WHERE device_id IN (SELECT device_id FROM sites {_where})")


# Orders are requests, customers are schools; those in debt wait for their monitor.
_DIMENSION = """WITH monitors AS (SELECT c_custkey AS SchoolId_short,
        CASE WHEN c_acctbal >= 0 THEN 'M' || CAST(c_custkey AS VARCHAR) END AS MonitorReferenceId FROM customer),
    dimension AS (SELECT o.o_orderkey AS request, CAST(o.o_custkey AS VARCHAR) AS SchoolId_long, o.o_orderdate AS asked,
        c.c_custkey AS SchoolId_short, m.MonitorReferenceId
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN monitors m ON m.SchoolId_short = c.c_custkey
        WHERE m.MonitorReferenceId IS NOT NULL) """


def _dimension(t: Tables):
    requests = t.table("orders").select(
        F.col("o_orderkey").alias("request"), F.col("o_custkey").cast("string").alias("SchoolId_long"), F.col("o_orderdate").alias("asked"))
    name = F.concat(F.lit("M"), F.col("c_custkey").cast("string"))
    owned = t.table("customer").select(
        F.col("c_custkey").alias("SchoolId_short"), F.when(F.col("c_acctbal") >= 0, name).alias("MonitorReferenceId"))
    return L.monitor_dimension(requests, _schools(t), owned)


@query("monitor_dimension", "request:i SchoolId_long:s SchoolId_short:i MonitorReferenceId:s asked:t", _DIMENSION + "SELECT * FROM dimension")
def monitor_dimension(t: Tables):
    return _dimension(t)


@query(
    "latest_per_monitor", "request:i SchoolId_long:s MonitorReferenceId:s asked:t",
    _DIMENSION + "SELECT * FROM dimension QUALIFY row_number() OVER (PARTITION BY MonitorReferenceId ORDER BY asked DESC, request DESC) = 1",
)
def latest_per_monitor(t: Tables):
    return L.latest_per_monitor(_dimension(t), F.col("asked"), F.col("request"))


# Roll-ups ----------------------------------------------------------------

@query(
    "hourly_mean", f"DateTime:t device_id:i {THREE} DateDevice:s Date:d",
    """SELECT *, strftime("Date", '%Y-%m-%d') || ' ' || CAST(device_id AS VARCHAR) AS "DateDevice" FROM hourly""",
)
def hourly_mean(t: Tables):
    return R.hourly_means(t.readings().withColumn("DateDevice", date_device()), READING_MEASURES)


@query(
    "daily_summary", f"Date:d device_id:i {FOUR}",
    f'SELECT "Date", device_id, {sql_four(*READING_MEASURES)} FROM readings GROUP BY 1, 2',
)
def daily_summary(t: Tables):
    return R.daily_summary(t.readings(), READING_MEASURES)


@query(
    "complete_day_summary", f"Date:d device_id:i hours:i {FOUR}",
    """WITH kept AS (SELECT * FROM readings QUALIFY count(*) OVER (PARTITION BY device_id, "Date") > 1),
        hours AS (SELECT date_trunc('hour', "DateTime") AS h, device_id, "Date", avg(rco2) AS rco2, avg(pm02) AS pm02, avg(atmp) AS atmp
            FROM kept GROUP BY 1, 2, 3) """
    + f'SELECT "Date", device_id, count(*) AS hours, {sql_four(*READING_MEASURES)} FROM hours GROUP BY 1, 2',
)
def complete_day_summary(t: Tables):
    """Summary of the hourly means of complete device-days."""
    kept = Q.keep_where(t.readings(), Q.complete(Q.Completeness(1)))
    hours = R.hourly_means(kept, READING_MEASURES)
    counts = hours.groupBy("Date", "device_id").agg(n_rows().alias("hours"))
    # An hourly series has at most 24 rows per device-day.
    return R.daily_summary(hours, READING_MEASURES, bounded=True).join(counts, ["Date", "device_id"])


@query("ensemble_hourly", f"DateTime:t {FOUR}", f'SELECT "DateTime", {sql_four(*READING_MEASURES)} FROM hourly GROUP BY 1')
def ensemble_hourly(t: Tables):
    return R.ensemble(R.hourly_means(t.readings(), READING_MEASURES), "DateTime", READING_MEASURES)


@query(
    "ensemble_daily", f"Date:d {FOUR}",
    'SELECT "Date", ' + sql_four(*READING_MEASURES)
    + ' FROM (SELECT "Date", device_id, avg(rco2) AS rco2, avg(pm02) AS pm02, avg(atmp) AS atmp FROM readings GROUP BY 1, 2) GROUP BY 1',
)
def ensemble_daily(t: Tables):
    return R.ensemble_of_daily_means(R.daily_summary(t.readings(), READING_MEASURES), READING_MEASURES)


@query(
    "mean_all_numeric", f"Date:d {' '.join(f'{m}:f {m}_median:f' for m in READING_MEASURES)}",
    'SELECT "Date", ' + ", ".join(f"avg({m}_mean) AS {m}, avg({m}_median) AS {m}_median" for m in READING_MEASURES)
    + f' FROM (SELECT "Date", device_id, {sql_four(*READING_MEASURES)} FROM readings GROUP BY 1, 2) GROUP BY 1',
)
def mean_all_numeric(t: Tables):
    daily = R.daily_summary(t.readings(), READING_MEASURES)
    return R.mean_of_all(R.strip_mean_suffix(daily.drop("device_id")), "Date")


@query(
    "network_hourly", "date:t indoor:f outdoor:f",
    """SELECT date_trunc('hour', "DateTime") AS date, avg(pm02) AS indoor, avg(pm2_5) AS outdoor FROM in_out GROUP BY 1""",
)
def network_hourly(t: Tables):
    return R.network_hourly(_in_out(t))


# Ventilation -------------------------------------------------------------

_TRAPEZOIDS = """WITH lagged AS (SELECT *, (rco2 - 412) / 1000000.0::DOUBLE AS x,
        coalesce(epoch("DateTime") - lag(epoch("DateTime")) OVER w, 0) AS dt,
        lag((rco2 - 412) / 1000000.0::DOUBLE, 1, 0) OVER w AS x0 FROM source
        WINDOW w AS (PARTITION BY device_id, "Date" ORDER BY "DateTime", reading_id)),
    traps AS (SELECT *, dt / 3600 * (x + x0) / 2 AS trap FROM lagged) """


def _ventilation_sql(group: str, hours: str, devices: str) -> str:
    return _TRAPEZOIDS.replace("source", f"(SELECT * FROM readings WHERE {hours} {devices})") + f""", days AS (
        SELECT device_id, "Date", CASE WHEN count(trap) = count(*) THEN sum(trap) END AS total,
            CASE WHEN count(rco2) = count(*) THEN avg(rco2) END AS mean FROM traps GROUP BY 1, 2)
        SELECT {group} d."Date", d.device_id, 0.001::DOUBLE * 5.24::DOUBLE * CASE WHEN s.SchoolType IN (1, 2, 3) THEN 3.1::DOUBLE ELSE 4.32::DOUBLE END
            / nullif(d.total, 0) AS pp_ventilation, d.mean AS "CO2_mean",
            strftime(d."Date", '%Y-%m-%d') || ' ' || CAST(d.device_id AS VARCHAR) AS "DateDevice"
        FROM days d LEFT JOIN sites s ON s.device_id = d.device_id"""


@query(
    "ventilation_by_day", "Date:d device_id:i pp_ventilation:f CO2_mean:f DateDevice:s",
    _ventilation_sql("", "true", ""),
)
def ventilation_by_day(t: Tables):
    return ventilation(t.readings(), t.sites(), first_hour=None, order=ORDER)


@query(
    "ventilation_by_school", "SchoolId_long:s Date:d device_id:i pp_ventilation:f CO2_mean:f",
    _ventilation_sql(
        "s.SchoolId_long,", 'hour("DateTime") BETWEEN 5 AND 22', "AND device_id IN (SELECT device_id FROM sites WHERE MonitoringType = 1)"),
)
def ventilation_by_school(t: Tables):
    single = L.devices_of_type(_schools(t), _school_devices(t), 1)
    return by_ventilation(ventilation(t.readings(), t.sites(), by_school=True, only_devices=single, order=ORDER))


@query(
    "running_integral", "reading_id:i t_diff:f C_trap:f C_integral:f",
    _TRAPEZOIDS.replace("rco2", "pm02").replace("source", "readings") + """SELECT reading_id, dt AS t_diff, trap * 1000 AS "C_trap",
        CASE WHEN count(trap) OVER f = count(*) OVER f THEN 1000 * sum(trap) OVER f END AS "C_integral" FROM traps
        WINDOW f AS (PARTITION BY device_id, "Date" ORDER BY "DateTime", reading_id ROWS UNBOUNDED PRECEDING)""",
)
def running_integral(t: Tables):
    # pm02 stands in for CO2 again; shown in thousandths.
    swapped = t.readings().drop("rco2").withColumnRenamed("pm02", "rco2")
    return with_running_integral(swapped, ORDER).withColumns({c: F.col(c) * 1000 for c in ("C_trap", "C_integral")})


# Reference tables ----------------------------------------------------------

@query(
    "lookup_null_safe", "c_custkey:i segment:s label:s",
    """SELECT c.c_custkey, c.segment, l.label FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer) c
        LEFT JOIN (SELECT nullif(c_mktsegment, 'BUILDING') AS name, 'first ' || CAST(min(c_custkey) AS VARCHAR) AS label FROM customer
            WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY 1) l ON c.segment IS NOT DISTINCT FROM l.name""",
)
def lookup_null_safe(t: Tables):
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    customers = t.table("customer").select("c_custkey", "c_mktsegment", segment.alias("segment"))
    known = customers.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"))
    labels = known.groupBy(F.col("segment").alias("name")).agg(
        F.concat(F.lit("first "), F.min("c_custkey").cast("string")).alias("label"))
    return L.lookup(customers, labels, {"segment": "name"})


_COUNTRIES = ("England", "Wales", "Scotland", "Northern Ireland", "Channel Islands")


def _country_sql() -> str:
    return "CASE c_nationkey % 6 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_COUNTRIES)) + " END"


def _country():
    n = F.col("c_nationkey") % 6
    out = F.when(n == 0, _COUNTRIES[0])
    for i, c in enumerate(_COUNTRIES[1:], 1):
        out = out.when(n == i, c)
    return out


@query(
    "country_branches", "c_custkey:i Country:s OutputArea:s RUC_code:s RUC:s EducationPhase:s",
    f"""WITH base AS (SELECT c_custkey, {_country_sql()} AS "Country", 'A' || CAST(c_custkey % 50 AS VARCHAR) AS "OutputArea", c_nationkey FROM customer),
        codes AS (SELECT 'A' || CAST(n_nationkey AS VARCHAR) AS area, n_nationkey AS n, n_name FROM nation)
    SELECT b.c_custkey, b."Country", b."OutputArea",
        CASE WHEN "Country" IN ('England', 'Wales') THEN 'E' || CAST(n AS VARCHAR) WHEN "Country" = 'Scotland' THEN CAST(n % 3 AS VARCHAR)
            WHEN "Country" = 'Northern Ireland' THEN CASE n % 4 WHEN 0 THEN 'Rural' WHEN 1 THEN 'Urban' WHEN 2 THEN 'Mixed urban/rural' WHEN 3 THEN 'Other' END
            ELSE 'channel island' END AS "RUC_code",
        CASE WHEN "Country" IN ('England', 'Wales') THEN codes.n_name
            WHEN "Country" = 'Scotland' THEN CASE n % 3 WHEN 1 THEN 'Urban Scotland' WHEN 2 THEN 'Rural Scotland' END
            WHEN "Country" = 'Northern Ireland' THEN CASE WHEN n % 4 = 0 THEN 'Rural NI' WHEN n % 4 IN (1, 2) THEN 'Urban NI' END
            ELSE 'Rural' END AS "RUC",
        CASE WHEN "Country" = 'Scotland' THEN 'S ' || k.n_name WHEN "Country" IN ('England', 'Wales') THEN 'E ' || k.n_name END AS "EducationPhase"
    FROM base b LEFT JOIN codes ON codes.area = b."OutputArea" LEFT JOIN nation k ON k.n_nationkey = b.c_nationkey
    WHERE b."Country" IS NOT NULL""",
)
def country_branches(t: Tables):
    base = t.table("customer").select(
        "c_custkey", _country().alias("Country"), F.concat(F.lit("A"), (F.col("c_custkey") % 50).cast("string")).alias("OutputArea"),
        F.col("c_nationkey").alias("EstablishmentId"))
    n = F.col("n_nationkey")
    nation = t.table("nation").withColumn("OutputArea", F.concat(F.lit("A"), n.cast("string")))
    irish = F.when(n % 4 == 0, "Rural").when(n % 4 == 1, "Urban").when(n % 4 == 2, "Mixed urban/rural").when(n % 4 == 3, "Other")
    rural = schools.rural_urban_tables(
        nation.select("OutputArea", F.concat(F.lit("E"), n.cast("string")).alias("RUC_code"), F.col("n_name").alias("RUC")),
        nation.select("OutputArea", (n % 3).alias("RUC_code")),
        nation.select("OutputArea", irish.alias("RUC_code")))
    registers = {
        name: nation.select(n.alias("EstablishmentId"), F.concat(F.lit(mark), F.col("n_name")).alias("EducationPhase"))
        for name, mark in (("England and Wales", "E "), ("Scotland", "S "))}
    return L.branch_lookup(schools.with_rural_urban(base, rural), schools.country_branch(), registers, ["EstablishmentId"])


@query(
    "natural_join", "nation:s region:s key:i",
    "SELECT n_name AS nation, r_name AS region, n_regionkey AS key FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
)
def natural_join(t: Tables):
    left = t.table("nation").select(F.col("n_name").alias("nation"), F.col("n_regionkey").alias("key"))
    return L.natural_join(left, t.table("region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("region")))


@query(
    "natural_full_join", "key:i c_name:s s_name:s",
    """SELECT coalesce(c_custkey, s_suppkey * 20) AS key, c_name, s_name FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 20""",
)
def natural_full_join(t: Tables):
    left = t.table("customer").select(F.col("c_custkey").alias("key"), "c_name")
    right = t.table("supplier").select((F.col("s_suppkey") * 20).alias("key"), "s_name")
    return L.natural_join(left, right, how="full")


@query(
    "unambiguous_value", "l_orderkey:i flag:s",
    """SELECT l_orderkey, max(flag) AS flag FROM (SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag FROM lineitem) GROUP BY 1
        HAVING count(DISTINCT flag) + max(CASE WHEN flag IS NULL THEN 1 ELSE 0 END) < 2""",
)
def unambiguous_value(t: Tables):
    flags = t.table("lineitem").select("l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"))
    return L.unambiguous(flags, "l_orderkey", "flag")


@query(
    "unambiguous_values", "o_orderkey:i flag:s status:s",
    """WITH v AS (SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag, l_linestatus AS status FROM lineitem),
        g AS (SELECT l_orderkey,
            CASE WHEN count(DISTINCT flag) + max(CASE WHEN flag IS NULL THEN 1 ELSE 0 END) < 2 THEN max(flag) END AS flag,
            CASE WHEN count(DISTINCT status) + max(CASE WHEN status IS NULL THEN 1 ELSE 0 END) < 2 THEN max(status) END AS status
            FROM v GROUP BY 1)
        SELECT o.o_orderkey, g.flag, g.status FROM orders o LEFT JOIN g ON o.o_orderkey = g.l_orderkey""",
)
def unambiguous_values(t: Tables):
    values = t.table("lineitem").select(
        "l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"), F.col("l_linestatus").alias("status"))
    agreed = L.unambiguous_values(values, "l_orderkey", ["flag", "status"])
    return L.lookup(t.table("orders").select("o_orderkey"), agreed, {"o_orderkey": "l_orderkey"})


# Raw postcodes in several spellings, made from every customer.
_RAW_SQL = """CASE c_custkey % 7 WHEN 0 THEN lower(substr(c_mktsegment, 1, 2)) || CAST(c_nationkey AS VARCHAR) || ' ' || CAST(c_custkey % 10 AS VARCHAR) || 'az'
        WHEN 1 THEN substr(c_mktsegment, 1, 1) || CAST(c_nationkey AS VARCHAR) || CAST(c_custkey % 10 AS VARCHAR) || 'QX'
        WHEN 2 THEN ' ' || substr(c_mktsegment, 1, 2) || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey % 10 AS VARCHAR) || 'BB  '
        WHEN 3 THEN '' WHEN 4 THEN 'X' || CAST(c_custkey % 10 AS VARCHAR) WHEN 5 THEN c_mktsegment || CAST(c_custkey AS VARCHAR) END"""


def _raw_postcodes(t: Tables):
    k, s, n = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    digit = (k % 10).cast("string")
    raw = (
        F.when(k % 7 == 0, F.concat(F.lower(F.substring(s, 1, 2)), n, F.lit(" "), digit, F.lit("az")))
        .when(k % 7 == 1, F.concat(F.substring(s, 1, 1), n, digit, F.lit("QX")))
        .when(k % 7 == 2, F.concat(F.lit(" "), F.substring(s, 1, 2), n, F.lit("-"), digit, F.lit("BB  ")))
        .when(k % 7 == 3, "").when(k % 7 == 4, F.concat(F.lit("X"), digit)).when(k % 7 == 5, F.concat(s, k.cast("string")))
    )
    return t.table("customer").select("c_custkey", raw.alias("raw"))


_POSTCODES = f"""WITH raws AS (SELECT c_custkey, {_RAW_SQL} AS raw FROM customer),
    stripped AS (SELECT *, regexp_replace(upper(raw), '[^A-Z0-9]', '', 'g') AS bare,
        regexp_replace(regexp_replace(upper(trim(raw)), '[^A-Z0-9 ]', '', 'g'), '\\s+', ' ', 'g') AS cleaned FROM raws),
    spaced AS (SELECT *, regexp_replace(bare, '([A-Z0-9])([0-9][A-Z]{{2}})$', '\\1 \\2') AS code FROM stripped),
    coded AS (SELECT c_custkey, raw, cleaned, CASE WHEN length(code) BETWEEN 5 AND 8 THEN code END AS formatted FROM spaced) """


@query(
    "postcode_clean", "c_custkey:i formatted:s cleaned:s area:s",
    _POSTCODES + """SELECT *, CASE WHEN regexp_matches(substr(formatted, 2, 1), '^[0-9]+$') THEN substr(formatted, 1, 1)
        ELSE substr(formatted, 1, 2) END AS area FROM coded""",
)
def postcode_clean(t: Tables):
    coded = _raw_postcodes(t).withColumns({"formatted": format_postcode("raw"), "cleaned": clean_postcode("raw")})
    return coded.withColumn("area", postcode_area("formatted"))


# Codes that do not end in X are live, those in BB without a position; codes from F on are (also) retired.
_POSITIONS = """, known AS (SELECT formatted AS pc, min(c_custkey) AS k FROM coded WHERE formatted IS NOT NULL GROUP BY 1),
    live AS (SELECT pc, CASE WHEN pc NOT LIKE '%BB' THEN 50 + k / 1000.0::DOUBLE END AS lat, -k / 1000.0::DOUBLE AS lon FROM known WHERE pc NOT LIKE '%X'),
    retired AS (SELECT pc, 60 + k / 1000.0::DOUBLE AS lat, k / 1000.0::DOUBLE AS lon FROM known WHERE pc >= 'F') """


def _postcode_tables(coded: DataFrame):
    known = coded.where(F.col("formatted").isNotNull()).groupBy(F.col("formatted").alias("pc_clean")).agg(F.min("c_custkey").alias("k"))
    k = F.col("k")
    live = known.where(~F.col("pc_clean").like("%X")).select(
        "pc_clean", F.when(~F.col("pc_clean").like("%BB"), 50 + k / 1000.0).alias("latitude"), (-k / 1000.0).alias("longitude"))
    retired = known.where(F.col("pc_clean") >= "F").select("pc_clean", (60 + k / 1000.0).alias("latitude"), (k / 1000.0).alias("longitude"))
    return live, retired


@query(
    "geocode_fallback", "c_custkey:i valid:b SchoolLatitude:f SchoolLongitude:f",
    _POSTCODES + _POSITIONS + """SELECT c.c_custkey, l.pc IS NOT NULL AS valid, coalesce(l.lat, r.lat) AS SchoolLatitude,
        CASE WHEN l.lat IS NOT NULL THEN l.lon ELSE r.lon END AS SchoolLongitude
        FROM coded c LEFT JOIN live l ON l.pc = c.formatted LEFT JOIN retired r ON r.pc = c.formatted""",
)
def geocode_fallback(t: Tables):
    coded = _raw_postcodes(t).withColumn("formatted", format_postcode("raw"))
    return L.geocode(coded, "formatted", *_postcode_tables(coded))


@query(
    "school_characteristics",
    "c_custkey:i pcode_region:s Country:s LSOA:s LocalAuthority:s RUC:s EducationPhase:s EPCBand:s FloorArea:f FractionalOccupancy:f "
    "valid:b SchoolLatitude:f",
    _POSTCODES + _POSITIONS + """, areas AS (SELECT *, CASE WHEN area < 'B' THEN 'Scotland' WHEN area < 'F' THEN 'England'
            WHEN area < 'H' THEN 'Channel Islands' WHEN area < 'M' THEN 'Northern Ireland' ELSE 'Elsewhere' END AS "Country"
            FROM (SELECT DISTINCT CASE WHEN regexp_matches(substr(pc, 2, 1), '^[0-9]+$') THEN substr(pc, 1, 1) ELSE substr(pc, 1, 2) END AS area FROM known)),
        base AS (SELECT c.*, CASE WHEN regexp_matches(substr(formatted, 2, 1), '^[0-9]+$') THEN substr(formatted, 1, 1) ELSE substr(formatted, 1, 2) END AS pcode_region,
            cu.c_nationkey FROM coded c JOIN customer cu USING (c_custkey)),
        certs AS (SELECT formatted AS pc, CASE WHEN count(DISTINCT m) < 2 THEN max(m) END AS "EPCBand",
            CASE WHEN count(DISTINCT f) < 2 THEN max(f) END AS "FloorArea" FROM
            (SELECT formatted, c_mktsegment AS m, CAST(c_nationkey AS DOUBLE) AS f FROM coded JOIN customer USING (c_custkey) WHERE formatted IS NOT NULL) GROUP BY 1)
    SELECT b.c_custkey, b.pcode_region, a."Country", 'L' || CAST(kn.k % 25 AS VARCHAR) AS "LSOA", na.n_name AS "LocalAuthority",
        CASE a."Country" WHEN 'England' THEN 'E ' || na.n_name WHEN 'Scotland' THEN CASE na.n_regionkey WHEN 1 THEN 'Urban Scotland' WHEN 2 THEN 'Rural Scotland' END
            WHEN 'Channel Islands' THEN 'Rural' END AS "RUC",
        CASE a."Country" WHEN 'Northern Ireland' THEN 'level ' || reg.n_name WHEN 'England' THEN 'phase ' || reg.n_name WHEN 'Scotland' THEN 'stage ' || reg.n_name END AS "EducationPhase",
        ce."EPCBand", ce."FloorArea",
        CASE a."Country" WHEN 'England' THEN reg.n_nationkey / nullif(CAST(reg.n_regionkey AS DOUBLE), 0) END AS "FractionalOccupancy",
        l.pc IS NOT NULL AS valid, coalesce(l.lat, r.lat) AS SchoolLatitude
    FROM base b JOIN areas a ON a.area = b.pcode_region AND a."Country" <> 'Elsewhere' LEFT JOIN known kn ON kn.pc = b.formatted
        LEFT JOIN nation na ON na.n_nationkey = kn.k % 25 LEFT JOIN nation reg ON reg.n_nationkey = b.c_nationkey
        LEFT JOIN certs ce ON ce.pc = b.formatted LEFT JOIN live l ON l.pc = b.formatted LEFT JOIN retired r ON r.pc = b.formatted""",
)
def school_characteristics(t: Tables):
    coded = _raw_postcodes(t).withColumn("formatted", format_postcode("raw"))
    customers = t.table("customer")
    monitors = coded.join(customers, "c_custkey").select(
        "c_custkey", F.col("formatted").alias("SchoolAddressPostCode"), F.col("c_nationkey").alias("EstablishmentId"))
    live, retired = _postcode_tables(coded)
    known = coded.where(F.col("formatted").isNotNull()).groupBy("formatted").agg(F.min("c_custkey").alias("k"))
    area = F.col("area")
    areas = known.select(postcode_area("formatted").alias("area")).distinct()
    country = F.when(area < "B", "Scotland").when(area < "F", "England").when(area < "H", "Channel Islands").when(
        area < "M", "Northern Ireland").otherwise("Elsewhere")
    number = (F.col("k") % 25).cast("string")
    nation = t.table("nation")
    area_code = F.concat(F.lit("O"), F.col("n_nationkey").cast("string")).alias("OutputArea")
    nothing = F.lit(None).cast("string")

    def register(mark: str, *extra):
        return nation.select(
            F.col("n_nationkey").alias("EstablishmentId"), F.concat(F.lit(mark), F.col("n_name")).alias("EducationPhase"),
            F.col("n_regionkey").cast("double").alias("PercentageFSM"), *extra)

    certificates = monitors.join(customers, "c_custkey").where(F.col("SchoolAddressPostCode").isNotNull()).select(
        F.col("SchoolAddressPostCode").alias("POSTCODE"), F.col("c_mktsegment").alias("EPCBand"),
        nothing.alias("MainHeatingFuel"), F.col("c_nationkey").cast("double").alias("FloorArea"), nothing.alias("BuildingEnvironment"))
    southern = F.col("FloorArea") < 12
    return schools.school_characteristics(monitors, {
        "areas": areas.select("area", country.alias("Country")),
        "postcodes": known.select(
            F.col("formatted").alias("Postcode"), F.concat(F.lit("L"), number).alias("LSOA"), F.concat(F.lit("O"), number).alias("OutputArea")),
        "deprivation": nation.select(
            F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("LSOA"), F.col("n_name").alias("LocalAuthority"),
            F.col("n_regionkey").alias("IMD_decile")),
        "rural_england_wales": nation.select(area_code, F.col("n_name").alias("RUC_code"), F.concat(F.lit("E "), "n_name").alias("RUC")),
        "rural_scotland": nation.select(area_code, F.col("n_regionkey").alias("RUC_code")),
        "rural_northern_ireland": nation.select(area_code, F.col("n_name").alias("RUC_code")),
        "register_england_wales": register("phase ", F.col("n_regionkey").alias("SchoolCapacity"), F.col("n_nationkey").alias("NumberOfPupils")),
        "register_scotland": register("stage "),
        "register_northern_ireland": register("level "),
        "certificates": certificates.where(southern),
        "certificates_scotland": certificates.where(~southern),
        "live_postcodes": live, "retired_postcodes": retired,
    })


@query(
    "union_aligned", "key:i name:s nation:i segment:s balance:f",
    """SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL AS balance FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, NULL, s_acctbal FROM supplier
        UNION ALL SELECT n_nationkey, n_name, n_nationkey, NULL, NULL FROM nation""",
)
def union_all_aligned(t: Tables):
    return union_aligned(
        t.table("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")),
        t.table("supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
        t.table("nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("nation")))


# Nearest station -----------------------------------------------------------

def _hourly_sites(t: Tables):
    sites = t.sites().select("device_id", "SchoolId_short", "SchoolLatitude", "SchoolLongitude")
    return L.natural_join(R.hourly_means(t.readings(), READING_MEASURES), sites, null_safe=False)


def _in_out(t: Tables):
    return link_outdoor(_hourly_sites(t), t.outdoor_located())


@query(
    "nearest_site_daily", "Date:d SchoolLatitude:f SchoolLongitude:f closest_station:i km_distance_to_station:f",
    "SELECT *, code AS closest_station, metres / 1000 AS km_distance_to_station FROM nearest",
)
def nearest_site_daily(t: Tables):
    return closest_station_each_day(_hourly_sites(t), t.outdoor_located())


@query(
    "in_out_link", f"DateTime:t Date:d device_id:i SchoolId_short:i {THREE} closest_station:i km_distance_to_station:f pm2_5:f site:s latitude:f",
    "SELECT * FROM in_out",
)
def in_out_link(t: Tables):
    return _in_out(t)


@query(
    "geodesic_distance", "c_custkey:i km:f km_sphere:f",
    f"""WITH p AS (SELECT c_custkey, SchoolLatitude AS a, SchoolLongitude AS b, 58.0::DOUBLE - c_nationkey / 4.0::DOUBLE AS c, c_nationkey / 20.0::DOUBLE AS d
            FROM sites JOIN customer ON c_custkey = device_id)
        SELECT c_custkey, {sql_distance("a", "b", "c", "d")}, metres / 1000 AS km,
            2 * 6371.0088::DOUBLE * asin(sqrt(least(power(sin((radians(c) - radians(a)) / 2), 2)
                + cos(radians(a)) * cos(radians(c)) * power(sin((radians(d) - radians(b)) / 2), 2), 1.0::DOUBLE))) AS km_sphere FROM p""",
)
def geodesic_distance(t: Tables):
    p = t.sites().select(
        F.col("device_id").alias("c_custkey"), "SchoolLatitude", "SchoolLongitude",
        (58.0 - F.col("SchoolType") / 4.0).alias("c"), (F.col("SchoolType") / 20.0).alias("d"))
    ends = ("SchoolLatitude", "SchoolLongitude", "c", "d")
    both = with_distance_m(with_distance_m(p, "m", *ends), "m_sphere", *ends, method="haversine")
    return both.withColumns({"km": F.col("m") / 1000, "km_sphere": F.col("m_sphere") / 1000})


_PAIRS = """WITH pairs AS (SELECT SchoolId_short, site AS station, arg_min(km_distance_to_station, "DateTime") AS distance_km FROM in_out
        WHERE SchoolLatitude IS NOT NULL AND latitude IS NOT NULL GROUP BY 1, 2) """


@query("site_pairs", "SchoolId_short:i station:s distance_km:f", _PAIRS + "SELECT * FROM pairs")
def site_pairs(t: Tables):
    return S.site_pairs(_in_out(t))


@query(
    "distance_summary", "n_schools:i mean_km:f median_km:f min_km:f max_km:f",
    _PAIRS + """SELECT count(DISTINCT SchoolId_short) AS n_schools, avg(distance_km) AS mean_km, quantile_cont(distance_km, 0.5) AS median_km,
        min(distance_km) AS min_km, max(distance_km) AS max_km FROM pairs""",
)
def distance_summary(t: Tables):
    return S.distance_summary(S.site_pairs(_in_out(t)))


# Statistics ----------------------------------------------------------------

_ANNUAL = """SELECT SchoolId_short, avg(pm02) AS indoor, avg(pm2_5) AS outdoor FROM shipments WHERE year("DateTime") = 1998 GROUP BY 1"""


@query(
    "annual_ratio", "SchoolId_short:i indoor:f outdoor:f io_ratio:f",
    f"SELECT *, indoor / outdoor AS io_ratio FROM ({_ANNUAL}) WHERE indoor IS NOT NULL AND outdoor > 0",
)
def annual_ratio(t: Tables):
    return S.annual_ratio(t.shipments(), 1998)


@query(
    "seasonal_ratio", "SchoolId_short:i Season:s indoor:f outdoor:f IO_ratio:f",
    """SELECT *, indoor / nullif(outdoor, 0) AS "IO_ratio" FROM (SELECT SchoolId_short,
        CASE WHEN month("DateTime") IN (12, 1, 2) THEN 'Winter' WHEN month("DateTime") <= 5 THEN 'Spring'
            WHEN month("DateTime") <= 8 THEN 'Summer' ELSE 'Autumn' END AS "Season",
        avg(pm02) AS indoor, avg(pm2_5) AS outdoor FROM shipments WHERE year("DateTime") = 1998 GROUP BY 1, 2)
        WHERE indoor IS NOT NULL AND outdoor <> 0""",
)
def seasonal_ratio(t: Tables):
    return S.seasonal_ratio(t.shipments(), 1998)


@query(
    "pearson", "r:f",
    "SELECT corr(pm02, pm2_5) AS r FROM shipments WHERE pm02 IS NOT NULL AND pm2_5 IS NOT NULL",
)
def pearson(t: Tables):
    return S.pearson(t.shipments(), "pm2_5", "pm02")


_FIT = """count(*) AS n, corr(l_extendedprice, l_quantity) AS r, regr_r2(l_extendedprice, l_quantity) AS r2,
        regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_slope(l_extendedprice, l_quantity) AS slope,
        sqrt((regr_syy(l_extendedprice, l_quantity) - regr_sxy(l_extendedprice, l_quantity) ** 2 / regr_sxx(l_extendedprice, l_quantity))
            / (count(*) - 2) / regr_sxx(l_extendedprice, l_quantity)) AS slope_se"""


@query("ols", "n:i r:f r2:f intercept:f slope:f slope_se:f", f"SELECT {_FIT} FROM lineitem")
def ols(t: Tables):
    return S.linear_fit(t.table("lineitem"), "l_quantity", "l_extendedprice")


@query(
    "ols_by_season", "Season:s n:i r:f r2:f intercept:f slope:f slope_se:f",
    f"""SELECT CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'Winter' WHEN month(l_shipdate) <= 5 THEN 'Spring'
            WHEN month(l_shipdate) <= 8 THEN 'Summer' ELSE 'Autumn' END AS "Season", {_FIT} FROM lineitem GROUP BY 1""",
)
def ols_by_season(t: Tables):
    return S.linear_fit(t.table("lineitem").withColumn("Season", times.season("l_shipdate")), "l_quantity", "l_extendedprice", by=["Season"])


def _number(c: str, digits: int) -> str:
    """A rounded number as text without trailing zeros."""
    return f"regexp_replace(CAST(round_even({c}, {digits}) AS VARCHAR), '[.]0$', '')"


@query(
    "figure_labels", "figure:s label:s",
    _PAIRS + f"""SELECT 'pairs' AS figure, 'n = ' || CAST(n AS VARCHAR) || chr(10) || 'Mean = ' || {_number("a", 1)} || ' km' || chr(10)
            || 'Median = ' || {_number("m", 1)} || ' km' || chr(10) || 'Range = ' || {_number("lo", 1)} || '–' || {_number("hi", 0)} || ' km' AS label
        FROM (SELECT count(DISTINCT SchoolId_short) AS n, avg(distance_km) AS a, quantile_cont(distance_km, 0.5) AS m, min(distance_km) AS lo, max(distance_km) AS hi FROM pairs)
        UNION ALL SELECT 'fit', 'n = ' || CAST(n AS VARCHAR) || chr(10) || 'r = ' || {_number("r", 2)} || chr(10) || 'R² = ' || {_number("r2", 2)} || chr(10)
            || 'Indoor = ' || {_number("intercept", 2)} || ' + ' || {_number("slope", 2)} || ' × Outdoor'
        FROM (SELECT {_FIT} FROM lineitem)""",
)
def figure_labels(t: Tables):
    pairs = S.distance_summary(S.site_pairs(_in_out(t))).select(F.lit("pairs").alias("figure"), "label")
    return union_aligned(pairs, S.with_regression_label(ols(t)).select(F.lit("fit").alias("figure"), "label"))


_PROFILES = {
    "weekday_hour": ("dayofweek(date) + 1", "hour(date)", "NULL"), "hour": ("NULL", "hour(date)", "NULL"),
    "weekday": ("dayofweek(date) + 1", "NULL", "NULL"), "month": ("NULL", "NULL", "month(date)"),
}


@query(
    "temporal_profile", "profile:s weekday:i hour:i month:i indoor:f outdoor:f",
    """WITH net AS (SELECT date_trunc('hour', "DateTime") AS date, avg(rco2) AS indoor, avg(pm02) AS outdoor FROM readings GROUP BY 1),
        overall AS (SELECT avg(indoor) AS mi, avg(outdoor) AS mo FROM net) """
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS profile, {d} AS weekday, {h} AS hour, {m} AS month, quantile_cont(indoor, 0.5) / (SELECT mi FROM overall) AS indoor,
            quantile_cont(outdoor, 0.5) / (SELECT mo FROM overall) AS outdoor FROM net GROUP BY ALL"""
        for name, (d, h, m) in _PROFILES.items()),
)
def temporal_profile(t: Tables):
    return S.temporal_profile(R.network_hourly(t.readings(), "rco2", "pm02"))


@query(
    "local_time", "event_id:i london:t text:s weekday:b",
    """SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/London' AS london, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text,
        dayofweek(ts) NOT IN (0, 6) AS weekday FROM events""",
)
def local_time(t: Tables):
    return t.table("events").select(
        "event_id", times.local_time("ts", "Europe/London").alias("london"), times.utc_text("ts").alias("text"),
        times.is_weekday("ts").alias("weekday"))


@query(
    "calendar_math", "o_orderkey:i first:d next:d last:d tomorrow:d hour_start:t seconds:f season:s",
    """SELECT o_orderkey, date_trunc('month', o_orderdate) AS first, date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS next,
        last_day(o_orderdate) AS last, o_orderdate + INTERVAL 1 DAY AS tomorrow, date_trunc('hour', o_orderdate) AS hour_start,
        epoch(o_orderdate) AS seconds, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) <= 5 THEN 'Spring'
            WHEN month(o_orderdate) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season FROM orders""",
)
def calendar_math(t: Tables):
    d = "o_orderdate"
    return t.table("orders").select(
        "o_orderkey", times.month_start(d).alias("first"), times.next_month(d).alias("next"),
        F.date_sub(times.next_month(d), 1).alias("last"), F.date_add(d, 1).alias("tomorrow"), times.floor_hour(d).alias("hour_start"),
        times.epoch_seconds(d).alias("seconds"), times.season(d).alias("season"))


# Whole jobs ----------------------------------------------------------------

def _dimensions(t: Tables):
    sites = t.sites()
    return reports.Dimensions(sites.select("device_id"), sites, sites, t.terms(), t.holidays())


def _totals(results: dict[str, DataFrame]) -> DataFrame:
    """Per table and numeric column: rows, rows with a value, sum of the values."""
    parts = []
    for name, df in results.items():
        numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
        sums = df.agg(n_rows().alias("n"), *[F.struct(F.lit(c).alias("column"), F.count(c).alias("filled"), F.sum(F.col(c).cast("double")).alias("total")).alias(f"c_{c}") for c in numeric])
        parts.append(sums.select(F.lit(name).alias("name"), "n", F.inline(F.array(*[f"c_{c}" for c in numeric]))))
    return union_aligned(*parts)


def _sql_totals(tables: dict[str, tuple[str, list[str]]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, count(*) AS n, '{c}' AS "column", count("{c}") AS filled, sum(CAST("{c}" AS DOUBLE)) AS total FROM {source}"""
        for name, (source, columns) in tables.items() for c in columns)


_MEANS = ", ".join(f"avg({m}) AS {m}" for m in READING_MEASURES)
_FOUR = [f"{m}_{x}" for m in READING_MEASURES for x in ("mean", "median", "q25", "q75")]
_OUTSIDE = ["SchoolId_short", "SchoolLatitude", "SchoolLongitude", "closest_station", "km_distance_to_station", "pm2_5", "latitude", "longitude", "site_type"]


def _stripped(extra: list[str] = []) -> str:
    return ", ".join(f"avg({c}) AS {c.removesuffix('_mean')}" for c in _FOUR + extra)


# The tables of the jobs, each once, from the clean minutes on.
_JOB = f"""clean_hourly AS (SELECT date_trunc('hour', "DateTime") AS "DateTime", device_id, "Date", {_MEANS} FROM minutes GROUP BY ALL),
    school_hourly AS (SELECT date_trunc('hour', "DateTime") AS "DateTime", device_id, "Date", {_MEANS} FROM school_minutes GROUP BY ALL),
    daily AS (SELECT "Date", device_id, {sql_four(*READING_MEASURES)} FROM minutes GROUP BY 1, 2),
    lagged AS (SELECT *, (rco2 - 412) / 1000000.0::DOUBLE AS x, coalesce(epoch("DateTime") - lag(epoch("DateTime")) OVER w, 0) AS dt,
        lag((rco2 - 412) / 1000000.0::DOUBLE, 1, 0) OVER w AS x0 FROM clean_hourly WHERE hour("DateTime") BETWEEN 5 AND 22
        WINDOW w AS (PARTITION BY device_id, "Date" ORDER BY "DateTime")),
    rate AS (SELECT device_id, "Date", 0.001::DOUBLE * 5.24::DOUBLE * any_value(CASE WHEN s.SchoolType IN (1, 2, 3) THEN 3.1::DOUBLE ELSE 4.32::DOUBLE END)
        / nullif(sum(dt / 3600 * (x + x0) / 2), 0) AS pp_ventilation, avg(rco2) AS "CO2_mean" FROM lagged JOIN sites s USING (device_id) GROUP BY 1, 2),
    rate_single AS (SELECT * FROM rate WHERE device_id IN (SELECT device_id FROM sites WHERE MonitoringType = 1)),
    day_hours AS (SELECT "Date", device_id, {sql_four(*READING_MEASURES)} FROM clean_hourly
        WHERE hour("DateTime") BETWEEN 9 AND 15 AND "Date" IN (SELECT "Date" FROM open_days) GROUP BY 1, 2),
    school_daily AS (SELECT * FROM day_hours LEFT JOIN rate USING (device_id, "Date")),
    school_daily_single AS (SELECT * FROM day_hours LEFT JOIN rate_single USING (device_id, "Date")),
    pairs AS (SELECT device_id, "DateTime", {", ".join(_OUTSIDE)} FROM in_out),
    paired_24 AS (SELECT * FROM clean_hourly JOIN pairs USING (device_id, "DateTime")),
    paired_school AS (SELECT * FROM school_hourly JOIN pairs USING (device_id, "DateTime")),
    mean_hourly AS (SELECT "DateTime", {_MEANS} FROM clean_hourly GROUP BY 1),
    mean_school_hourly AS (SELECT "DateTime", {_MEANS} FROM school_hourly GROUP BY 1),
    mean_daily AS (SELECT "Date", {_stripped()} FROM daily GROUP BY 1),
    mean_school_daily AS (SELECT "Date", {_stripped(["pp_ventilation", "CO2_mean"])} FROM school_daily GROUP BY 1),
    four_minutes AS (SELECT "DateTime", {sql_four(*READING_MEASURES)} FROM minutes GROUP BY 1),
    four_school_minutes AS (SELECT "DateTime", {sql_four(*READING_MEASURES)} FROM school_minutes GROUP BY 1),
    four_hourly AS (SELECT "DateTime", {sql_four(*READING_MEASURES)} FROM clean_hourly GROUP BY 1),
    four_school_hourly AS (SELECT "DateTime", {sql_four(*READING_MEASURES)} FROM school_hourly GROUP BY 1),
    four_daily AS (SELECT "Date", {sql_four(*READING_MEASURES)} FROM (SELECT "Date", rco2_mean AS rco2, pm02_mean AS pm02, atmp_mean AS atmp FROM daily) GROUP BY 1),
    four_school_daily AS (SELECT "Date", {sql_four(*READING_MEASURES)} FROM (SELECT "Date", rco2_mean AS rco2, pm02_mean AS pm02, atmp_mean AS atmp FROM day_hours) GROUP BY 1)"""

_HOURLY, _RATE, _PAIRED = ["device_id", *READING_MEASURES], ["pp_ventilation", "CO2_mean"], ["device_id", *READING_MEASURES, *_OUTSIDE]
_MONTH_TABLES = {
    "indoor_hourly_24": ("clean_hourly", _HOURLY), "indoor_hourly_school": ("school_hourly", _HOURLY),
    "indoor_daily_24": ("daily", ["device_id", *_FOUR]), "indoor_daily_school": ("school_daily", ["device_id", *_FOUR, *_RATE]),
    "ventilation": ("rate", ["device_id", *_RATE]), "in_out_24": ("paired_24", _PAIRED), "in_out_school": ("paired_school", _PAIRED),
    "ensemble_hourly_school": ("mean_school_hourly", list(READING_MEASURES)), "ensemble_hourly_24": ("mean_hourly", list(READING_MEASURES)),
    "ensemble_daily_school": ("mean_school_daily", [c.removesuffix("_mean") for c in [*_FOUR, *_RATE]]),
    "ensemble_daily_24": ("mean_daily", [c.removesuffix("_mean") for c in _FOUR]),
}
_PERIOD_TABLES = {
    **{name: _MONTH_TABLES[name] for name in ("indoor_hourly_24", "indoor_hourly_school", "indoor_daily_24", "in_out_24", "in_out_school")},
    "indoor_daily_school": ("school_daily_single", ["device_id", *_FOUR, *_RATE]), "ventilation": ("rate_single", ["device_id", *_RATE]),
    "ensemble_minutes_school": ("four_school_minutes", _FOUR), "ensemble_hourly_school": ("four_school_hourly", _FOUR),
    "ensemble_daily_school": ("four_school_daily", _FOUR), "ensemble_minutes_24": ("four_minutes", _FOUR),
    "ensemble_hourly_24": ("four_hourly", _FOUR), "ensemble_daily_24": ("four_daily", _FOUR),
    "outdoor": ("outdoor_located", ["code", "pm2_5", "latitude", "longitude", "site_type"]),
}


@query("month_tables", "name:s column:s n:i filled:i total:f", f"WITH {_JOB} {_sql_totals(_MONTH_TABLES)}")
def month_tables(t: Tables):
    """Every numeric column of all eleven tables."""
    return _totals(reports.month_tables(t.readings(), t.outdoor_located(), _dimensions(t), RULES))


@query("period_tables", "name:s column:s n:i filled:i total:f", f"WITH {_JOB} {_sql_totals(_PERIOD_TABLES)}")
def period_tables(t: Tables):
    """Every numeric column of all fourteen tables."""
    single = L.devices_of_type(_schools(t), _school_devices(t), 1)
    return _totals(reports.period_tables(t.readings(), t.outdoor_located(), _dimensions(t), single, RULES))


class MovedTables(Tables):
    """The tables with the events dealt over four months."""

    def table(self, name: str) -> DataFrame:
        df = super().table(name)
        if name != "events":
            return df
        return df.withColumn("ts", F.col("ts") + F.make_dt_interval((F.col("event_id") % 4 * 31).cast("int")))


@query(
    "months_run", "name:s column:s n:i filled:i total:f",
    # A table of this name hides the given one from all views below.
    f"""SELECT * FROM (WITH events AS MATERIALIZED (SELECT * REPLACE (ts + to_days(CAST(event_id % 4 * 31 AS INTEGER)) AS ts) FROM events),
        {{views}}, {_JOB} {_sql_totals({n: (f'(SELECT * FROM {x} WHERE CAST("{d}" AS DATE) < DATE %s)' % "'2024-04-01'", c) for n, (x, c) in _MONTH_TABLES.items()
        for d in ["Date" if n in ("indoor_daily_24", "indoor_daily_school", "ventilation", "ensemble_daily_school", "ensemble_daily_24") else "DateTime"]})})""",
)
def months_run(t: Tables):
    """Three months run and loaded again, of readings and outdoor data of four months and more."""
    moved, root = MovedTables(t.spark, t.folder), scratch_path(t.spark, "run")

    def series_of(start: date, stop: date) -> DataFrame:
        return series.in_range(moved.readings(), str(start), str(stop), time="DateTime")

    months = [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
    reports.run_months(t.spark, root, months[:1], series_of, moved.outdoor_located(), _dimensions(t), RULES)
    assert reports.run_months(t.spark, root, months, series_of, moved.outdoor_located(), _dimensions(t), RULES) == months[1:]
    return _totals({name: df.drop("year", "month") for name, df in reports.load_months(t.spark, root, list(_MONTH_TABLES)).items()})
