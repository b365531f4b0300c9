"""Outdoor series: background stations with nearly complete days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.functions.times import local_date, local_time
from airq.operators import quality as Q
from airq.operators.lookup import natural_join
from airq.sources.series import background_stations, station_readings


def outdoor_clean(
    hourly: DataFrame,
    meta: DataFrame,
    years=None,
    time: str = "date",
    rule: Q.Completeness = Q.FULL_DAY_HOURS,
    pm25: str = "pm2_5",
    max_missing: float = 0.25,
    tz: str = "UTC",
    local: str = "Europe/London",
    excluded=None,
) -> DataFrame:
    """Station readings of complete days with the station's metadata.

    ``DateTime`` stays the UTC instant that joins with indoor readings;
    ``LocalTime`` is the wall clock in ``local``. Both day rules are decided in
    one aggregation.
    """
    stations = background_stations(meta) if excluded is None else background_stations(meta, excluded)
    df = station_readings(hourly, stations, years, time).withColumnRenamed(time, "DateTime")
    df = df.withColumnsRenamed({"pm10": "pm10_out", "pm2.5": "pm2_5"})
    df = df.withColumns({"Date": local_date("DateTime", tz), "LocalTime": local_time("DateTime", local)})
    kept = Q.keep_where(df, Q.complete(rule), Q.mostly_present(pm25, max_missing), keys=("Date", "code"))
    kept = kept.withColumn("DateCode", F.concat(F.col("Date").cast("string"), F.col("code").cast("string")))
    return natural_join(kept, stations, null_safe=False)
