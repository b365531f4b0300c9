"""Writing results: a snapshot, or month by month with resumption.

Every table is written once, to its final place, also if others are made from
it: a job gets ``keep(name, df)``, which writes the table and gives a reader of it.
A month is finished when its manifest exists, which is written after
all tables. A month that broke off is computed and overwritten again. A
snapshot is a folder of its own until a pointer to it exists, so readers see
all tables of one write or all of another.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from airq.sources.staging import staged_within

MANIFESTS = "finished_months"
VERSIONS, POINTERS = "versions", "current"
#: Snapshots that stay: the current one, and the one before for those who still read it.
SNAPSHOTS = 2

Keep = Callable[[str, DataFrame], DataFrame]


class Written:
    """Writes tables to their places, each once."""

    def __init__(self, place: Callable[[str], str]):
        self.place, self.schemas = place, {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        if name in self.schemas:
            raise ValueError(f"{name} is written already")
        df.write.mode("overwrite").parquet(self.place(name))
        self.schemas[name] = df.schema
        return df.sparkSession.read.schema(df.schema).parquet(self.place(name))

    def rest(self, tables: Mapping[str, DataFrame]) -> None:
        """Write those that are not written yet."""
        for name, df in tables.items():
            if name not in self.schemas:
                self(name, df)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    system, target = _files(spark, path)
    return system.exists(target)


def _snapshots(spark: SparkSession, root: str) -> list[str]:
    """Pointers to complete snapshots, oldest first."""
    system, target = _files(spark, f"{root}/{POINTERS}")
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def write_snapshot(tables: Mapping[str, DataFrame] | Callable[[Keep], Mapping[str, DataFrame]], root: str, spark: SparkSession | None = None) -> None:
    """Write all tables as the new state of ``root``; a write that breaks off leaves the old state.

    ``tables`` may be a job that makes them and is given ``keep``; it needs ``spark``.
    """
    spark = spark or next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex
    written = Written(lambda name: f"{root}/{VERSIONS}/{version}/{name}")
    with staged_within(spark):
        written.rest(tables(written) if callable(tables) else tables)
    before = _snapshots(spark, root)
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    # One empty file, whose name holds all: it is there or it is not.
    system, target = _files(spark, f"{root}/{POINTERS}/{number:012d}-{version}")
    system.create(target).close()
    for old in _snapshots(spark, root)[:-SNAPSHOTS]:
        for path, deep in ((f"{root}/{POINTERS}/{old}", False), (f"{root}/{VERSIONS}/{old.split('-')[1]}", True)):
            system, target = _files(spark, path)
            system.delete(target, deep)


def read_snapshot(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The tables of the last complete snapshot."""
    pointers = _snapshots(spark, root)
    if not pointers:
        raise FileNotFoundError(f"no complete snapshot in {root}")
    version = pointers[-1].split("-")[1]
    return {name: spark.read.parquet(f"{root}/{VERSIONS}/{version}/{name}") for name in names}


def _part(month: date) -> str:
    return f"year={month.year}/month={month.month}"


def _manifests(spark: SparkSession, root: str) -> dict[date, set[str]]:
    """Finished months in order, with the names of their tables."""
    if not _exists(spark, f"{root}/{MANIFESTS}"):
        return {}
    rows = spark.read.parquet(f"{root}/{MANIFESTS}").select("year", "month", "name").collect()  # one row per month and table
    found: dict[date, set[str]] = {}
    for r in sorted(rows, key=lambda r: (r.year, r.month)):
        found.setdefault(date(r.year, r.month, 1), set()).add(r["name"])
    return found


def finished_months(spark: SparkSession, root: str) -> list[date]:
    return list(_manifests(spark, root))


def write_months(
    spark: SparkSession, root: str, months: Iterable[date], make: Callable[[date, Keep], Mapping[str, DataFrame]]
) -> list[date]:
    """Compute and write the months that are not finished; returns those.

    ``make(month, keep)`` gives the month's tables. Those that others are made from it passes
    to ``keep`` and reads from their final place; what it stages is removed once the month is written.
    """
    finished = set(finished_months(spark, root))
    done = []
    for month in months:
        if month in finished:
            continue
        with staged_within(spark):
            written = Written(lambda name: f"{root}/{name}/{_part(month)}")  # noqa: B023
            written.rest(make(month, written))
            manifest = spark.createDataFrame([(name, schema.simpleString()) for name, schema in written.schemas.items()], "name string, columns string")
            manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/{MANIFESTS}/{_part(month)}")
        done.append(month)
    return done


def read_months(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Each table over all finished months, with ``year`` and ``month``."""
    manifests, tables = _manifests(spark, root), {}
    for name in names:
        parts = [_part(month) for month, held in manifests.items() if name in held]
        if not parts:
            raise FileNotFoundError(f"no finished month with {name} in {root}")
        reader = spark.read.options(basePath=f"{root}/{name}", mergeSchema=True)
        tables[name] = reader.parquet(*[f"{root}/{name}/{p}" for p in parts])
    return tables
