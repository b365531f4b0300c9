"""Joins with reference tables.

Reference tables carry no broadcast hint: Spark knows their size (files, staged
tables, local rows) and broadcasts below its threshold; above it the join
shuffles and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.functions.aggregates import single_valued
from airq.operators.align import union_aligned


#: Rows with a missing key meet those of the table in so many parts.
PARTS = 16
#: Joins that give no row of the table on its own, so that its rows may stand in several parts.
_SPREAD = {"left", "leftouter", "left_outer", "inner", "semi", "leftsemi", "left_semi", "anti", "leftanti", "left_anti"}


def lookup(df: DataFrame, table: DataFrame, on: Mapping[str, str] | Sequence[str], null_safe: bool = True, how: str = "left") -> DataFrame:
    """Join ``table`` by differently named keys; missing keys match missing keys.

    ``on`` maps columns of ``df`` to columns of ``table``; the keys of
    ``table`` are dropped. Missing keys are often many and would all meet in
    one task: rows of ``df`` that lack a key are dealt to ``PARTS`` parts by
    their values, and the rows of ``table`` that lack one stand in each part.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    renamed = table.withColumnsRenamed({k: f"_k_{k}" for k in pairs.values()})
    keys = [f"_k_{b}" for b in pairs.values()]
    if null_safe and how in _SPREAD and any(table.schema[b].nullable and df.schema[a].nullable for a, b in pairs.items()):
        values = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
        df = df.withColumn("_lookup_part", F.when(_lacks(pairs), F.pmod(F.xxhash64(*values), F.lit(PARTS)).cast("int")).otherwise(0))
        parts = F.when(_lacks(keys), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
        renamed, keys = renamed.withColumn("_k__lookup_part", F.explode(parts)), [*keys, "_k__lookup_part"]
    equal = [
        df[a].eqNullSafe(renamed[k]) if null_safe and a != "_lookup_part" else df[a] == renamed[k]
        for a, k in zip([*pairs, "_lookup_part"], keys)
    ]
    return df.join(renamed, reduce(and_, equal), how).drop("_lookup_part", *keys)


def _lacks(keys) -> Column:
    return reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])


def natural_join(left: DataFrame, right: DataFrame, how: str = "left", null_safe: bool = True) -> DataFrame:
    """Join on all columns the two tables share."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("the tables share no column")
    if how == "left":
        return lookup(left, right, common, null_safe)
    return left.join(right, common, how)


def monitor_dimension(requests: DataFrame, schools: DataFrame, monitors: DataFrame) -> DataFrame:
    """Requests with their school and each monitor of it.

    A school that filed several requests repeats its monitors; see
    `latest_per_monitor` for one row per monitor.
    """
    linked = lookup(lookup(requests, schools, ["SchoolId_long"]), monitors, ["SchoolId_short"])
    return linked.where(F.col("MonitorReferenceId").isNotNull())


def latest_per_monitor(dimension: DataFrame, *newest: Column) -> DataFrame:
    """One row per monitor, the one with the greatest ``newest`` values."""
    key = "MonitorReferenceId"
    rest = [c for c in dimension.columns if c != key]
    row = F.struct(*[F.col(c) for c in rest])
    latest = dimension.groupBy(key).agg(F.max_by(row, F.struct(*newest, row)).alias("_row"))
    return latest.select(key, "_row.*")


def devices_of_type(schools: DataFrame, dimension: DataFrame, monitoring_type: int | None = None) -> DataFrame:
    """Device ids of schools with one monitoring type, or of all schools."""
    devices = dimension
    if monitoring_type is not None:
        chosen = schools.where(F.col("MonitoringType") == monitoring_type).select("SchoolId_long")
        devices = dimension.join(chosen, "SchoolId_long", "left_semi")
    ids = devices.select(F.col("MonitorReferenceId").alias("device_id"))
    return ids.where(F.col("device_id").isNotNull()).distinct()


def keep_devices(df: DataFrame, devices: DataFrame) -> DataFrame:
    return df.join(devices, "device_id", "left_semi")


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose rows agree on ``value``, with that value (it may be missing)."""
    one = df.groupBy(key).agg(single_valued(value).alias("_one"), F.max(value).alias(value))
    return one.where("_one").select(key, value)


def unambiguous_values(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The same for several values in one aggregation: NULL where rows disagree.

    For a left join by key this equals one lookup per value.
    """
    agreed = [F.when(single_valued(v), F.max(v)).alias(v) for v in values]
    return df.groupBy(key).agg(*agreed)


def branch_lookup(df: DataFrame, branch: Column, tables: Mapping[str, DataFrame], on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Look up each row in the table of its branch, with a single join.

    The tables are stacked with their branch name as one more key, so rows of
    different branches never meet. Rows whose branch is NULL are dropped; rows
    of a branch without a table keep NULLs.
    """
    stacked = union_aligned(*[t.withColumn("_branch", F.lit(name)) for name, t in tables.items()])
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    tagged = df.withColumn("_branch", branch).where(F.col("_branch").isNotNull())
    return lookup(tagged, stacked, {**pairs, "_branch": "_branch"}).drop("_branch")


def geocode(df: DataFrame, code: str, live: DataFrame, retired: DataFrame) -> DataFrame:
    """Coordinates by cleaned postcode: live table first, then the retired one.

    Adds ``valid`` (the code is live), ``SchoolLatitude`` and ``SchoolLongitude``.
    The tables have one row per ``pc_clean``.
    """
    a = live.select(F.col("pc_clean").alias("_a"), F.col("latitude").alias("_a_lat"), F.col("longitude").alias("_a_lon"))
    b = retired.select(F.col("pc_clean").alias("_b"), F.col("latitude").alias("_b_lat"), F.col("longitude").alias("_b_lon"))
    joined = df.join(a, F.col(code) == F.col("_a"), "left").join(b, F.col(code) == F.col("_b"), "left")
    known = F.col("_a_lat").isNotNull()
    return joined.withColumns({
        "valid": F.col("_a").isNotNull(),
        "SchoolLatitude": F.when(known, F.col("_a_lat")).otherwise(F.col("_b_lat")),
        "SchoolLongitude": F.when(known, F.col("_a_lon")).otherwise(F.when(F.col("_b_lat").isNotNull(), F.col("_b_lon"))),
    }).drop("_a", "_a_lat", "_a_lon", "_b", "_b_lat", "_b_lon")
