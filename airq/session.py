"""Session settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Spark's limit on the bytes of rows that go to a Python worker at once, 64 MB by default; the JVM and the worker hold a batch several times over.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def local_session(cpus: int | None = None, name: str = "airq") -> SparkSession:
    """A local session for tests and timings."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        # Test tables are small; keep their shuffles spread over the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def bound_batches(spark: SparkSession) -> None:
    """From now on rows go to Python workers in batches of about ``BATCH_BYTES``; a limit that the session has already stays.

    The limit is the session's, as a table that is returned unwritten is planned only when its reader writes it. It changes no rows.
    """
    if BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)
