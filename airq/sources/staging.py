"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A staged table cuts the lineage, survives the loss of executors, keeps column
pruning for its readers and tells Spark its true size, so that the optimizer's
own broadcast threshold decides about later joins. Once it is written nothing
reads the shuffles that made it, so Spark removes their files there and then
instead of keeping them until the driver collects its garbage.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Tables staged outside any block; each block and thread of its own has its own list.
_staged: list[str] = []
_inside: ContextVar[list[str] | None] = ContextVar("staged_inside", default=None)
#: Spark's setting to remove an execution's shuffle files when it ends, and how many blocks of a session want it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_wanted: dict[str, tuple[int, str | None]] = {}
_lock = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/airq/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Executions of the block leave no shuffle files; the setting is as before when the last block of the session ends."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        blocks, before = _wanted.get(session, (0, spark.conf.get(CLEANUP, None)))
        _wanted[session] = (blocks + 1, before)
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            blocks, before = _wanted.pop(session)
            if blocks > 1:
                _wanted[session] = (blocks - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and return a reader of the written table; filters on the columns ``by`` prune its folders."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    inside = _inside.get()
    (_staged if inside is None else inside).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, paths: list[str]) -> int:
    removed = 0
    while paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        removed += target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return removed


def release(*tables: DataFrame) -> int:
    """Remove staged tables that nothing unwritten reads any more; tables without files stay."""
    removed = 0
    for table in tables:
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()[:1]}:
            removed += _remove(table.sparkSession, [path])
    return removed


def release_staged(spark: SparkSession) -> int:
    """Remove the tables staged outside any ``staged_within`` block."""
    return _remove(spark, _staged)


@contextmanager
def staged_within(spark: SparkSession):
    """Remove the tables staged inside the block, by this thread, when it ends."""
    own: list[str] = []
    token = _inside.set(own)
    try:
        yield
    finally:
        _inside.reset(token)
        _remove(spark, own)
