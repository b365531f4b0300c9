"""Shards along a Hilbert curve over metadata.

Each dimension is cut at its quantiles over all rows, texts by their whole values; a row's cell has an index
on the curve, on which neighbours in all dimensions are near each other. Rows
in the order of that index are cut into runs of equal counts. A shard then
covers a small range of every dimension, and files are skipped by any of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.sources.staging import stage

BITS = 6


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer cells (rows, dimensions), by the transposition of Skilling (2004)."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(high, p, 0) ^ swap
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    index = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[:, i] >> b) & 1)
    return index


def cells_of(df: DataFrame, column: str, bits: int) -> Column:
    """The cell of each text of a column, from 0 to 2^bits - 1, by the share of rows up to its whole value.

    Distinct values are counted and put in order by range partitions; only the first value of each cell
    and one sum per partition come to the driver.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    parted = stage(values.repartitionByRange(n, "value").withColumn("part", F.spark_partition_id()), "values")
    before, starts = 0, []
    for r in parted.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # one row per partition
        starts.append((r["part"], before))
        before += r["n"]
    if not before:
        return F.lit(None).cast("double")
    starts = F.broadcast(df.sparkSession.createDataFrame(starts, "part int, before long"))
    upto = F.sum("n").over(W.partitionBy("part").orderBy("value")) + F.col("before")
    cell = F.least(F.floor(upto * float(1 << bits) / before), F.lit((1 << bits) - 1)).cast("int")
    heads = parted.join(starts, "part").select("value", cell.alias("cell")).groupBy("cell").agg(F.min("value").alias("value")).collect()  # 2^bits rows at most
    known = F.array(*[F.struct(F.lit(r["value"]).alias("value"), F.lit(r["cell"]).alias("cell")) for r in heads])
    return F.array_max(F.transform(F.filter(known, lambda h: h["value"] <= F.col(column)), lambda h: h["cell"])).cast("double")


def curved(rows: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """Adds ``curve``, the rows' index on the curve; null values are in the lowest cell of their dimension."""
    kinds = dict(rows.dtypes)
    texts = [kinds[d] == "string" for d in dimensions]
    rows = rows.select("*", *[(cells_of(rows, d, bits) if text else F.col(d).cast("double")).alias(f"dim_{i}") for i, (d, text) in enumerate(zip(dimensions, texts))])
    parts = [j / (1 << bits) for j in range(1, 1 << bits)]
    numbers = [f"dim_{i}" for i, text in enumerate(texts) if not text]
    found = rows.agg(*[F.percentile_approx(c, parts, 10_000).alias(c) for c in numbers]).first() if numbers else {}  # 2^bits numbers per dimension
    # A cut that repeats counts as often: few values are spread over all cells by their shares of the rows.
    cuts = [np.arange(1, 1 << bits, dtype=float) if text else np.array(found[f"dim_{i}"] or [], float) for i, text in enumerate(texts)]

    @F.pandas_udf("long")
    def index(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            cells = [np.where(pd.isna(c), 0, np.searchsorted(cut, np.nan_to_num(c.to_numpy(float)), "right")) for c, cut in zip(columns, cuts)]
            yield pd.Series(curve_index(np.stack(cells, 1), bits))

    return rows.withColumn("curve", index(*[F.col(f"dim_{i}") for i in range(len(dimensions))])).drop(*[f"dim_{i}" for i in range(len(dimensions))])


def ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Adds ``rank``, the place from 0 in the order of these columns, and tells the number of rows.

    Rows go to range partitions, once, and are written with their partition's number; the partitions'
    counts, of which there are few, say where each begins.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parted = stage(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "parts")
    before, starts = 0, []
    for r in parted.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # one row per partition
        starts.append((r["part"], before))
        before += r["n"]
    starts = F.broadcast(spark.createDataFrame(starts, "part int, before long"))
    place = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    return parted.join(starts, "part").withColumn("rank", place + F.col("before")).drop("part", "before"), before


def shards(docs: DataFrame, dimensions: tuple[str, ...] = ("lang", "source", "size"), n: int = 8) -> DataFrame:
    """Per row: doc_id, size, text_crc32, curve, shard from 0, slot without gaps from 0 in each shard.

    Counts of shards differ by one at most. ``size`` is the text's UTF-8 bytes plus 1. Rows with equal index
    go by their text, so equal texts with equal metadata stand together, then by doc_id; rows that repeat in
    all of that are interchangeable. Null texts have no bytes. An empty table has no rows.
    """
    body = F.coalesce("text", F.lit("")).cast("binary")
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long")
    own = [F.col(f"`{d}`") for d in dimensions if d != "size"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64("text").alias("text_hash"), *[c.alias(f"m_{i}") for i, c in enumerate(own)])
    rows = stage(rows, "metadata")
    names = iter(f"m_{i}" for i in range(len(own)))
    placed, total = ranked(curved(rows, [d if d == "size" else next(names) for d in dimensions]), ["curve", "text_hash", "doc_id"])
    placed = placed.withColumn("shard", F.expr(f"CAST(rank * {n} div {max(total, 1)} AS int)"))
    first = F.expr(f"(shard * {total}L + {n - 1}) div {n}")
    return placed.withColumn("slot", F.col("rank") - first).drop("rank", "text_hash")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return shards(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
