"""Packing into windows: non-negative least squares over length combinations.

Documents become token pieces of at most a window. The pieces' lengths, counted
over the whole corpus, are one histogram with as many bins as the window has
tokens. Combinations of few lengths that fill a window are its columns; the
least squares fit says how often to use each. Rounded down, they take most
pieces; a greedy pass packs what is left. All of that works on the histogram,
whose size does not depend on the corpus. The pieces then get their places by
their rank among the pieces of their length.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.llm.bpe import SPLIT, VOCABULARY, Bpe, Known
from airq.sources.staging import stage

WINDOW = 2048
END = 1
PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"


def pieces(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """Token pieces of whole documents: full windows and one rest per document.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. A null text
    counts as empty and gives the closing id alone. Rows that repeat give their pieces each.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(public_tokenizers.path(vocabulary))
        fast = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=bpe.ids, special_tokens=bpe.special)

        def encode(text: str) -> list[int]:
            try:
                if any(s in text for s in bpe.special):
                    return fast.encode(text, allowed_special="all")
                return fast.encode_ordinary(text)
            except BaseException as error:  # a run too long for its pattern matcher
                if type(error).__name__ != "PanicException":
                    raise
                return bpe.encode_texts([text], Known())[0].tolist()

        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = np.array([*encode(text or ""), end], "<u4")
                rows += [(doc_id, a, min(window, len(ids) - a), len(ids), ids[a : a + window].tobytes()) for a in range(0, len(ids), window)]
                size += len(ids)
                if size > 1_000_000:
                    yield frame(rows)
                    rows, size = [], 0
            if rows:
                yield frame(rows)

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "start", "length", "doc_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(cut, PIECE)


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int, partners: int = 8) -> list[tuple[int, ...]]:
    """Combinations of lengths at hand that fill a window: two lengths, three with a common one, one length repeated with a rest."""
    have = dict(zip(lengths.tolist(), counts.tolist()))
    found = {(window,)} if window in have else set()
    common = lengths[np.argsort(-counts, kind="stable")]
    for a in lengths.tolist():
        if window - a in have:
            found.add(tuple(sorted((a, window - a))))
        b = common[common < window - a]
        c = window - a - b
        fits = np.isin(c, lengths)
        found.update(tuple(sorted((a, x, y))) for x, y in zip(b[fits][:partners].tolist(), c[fits][:partners].tolist()))
        for k in range(2, window // a + 1) if a * 16 >= window else (window // a,):
            rest = window - k * a
            if not rest or rest in have:
                found.add((*[a] * k, *[rest] * (rest > 0)))
    return sorted(found)


def least_squares(columns: list[tuple[int, ...]], counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Counts x >= 0 of the columns that bring A x closest to ``counts``, by accelerated projected gradients."""
    of = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    at = np.fromiter((a for c in columns for a in c), np.int64, len(of))
    scale = max(1.0, float(counts.max(initial=0)))
    goal = counts / scale
    up = lambda x: np.bincount(at, weights=x[of], minlength=len(counts))
    down = lambda r: np.bincount(of, weights=r[at], minlength=len(columns))
    v = np.ones(len(columns))
    for _ in range(30):
        v = down(up(v))
        norm = float(np.linalg.norm(v))
        v /= norm
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(steps):
        z = np.maximum(0, y - down(up(y) - goal) / (1.05 * norm))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        x, y = z, z + (before - 1) / t * (z - x)
    return x * scale


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their repeat counts that use up the histogram exactly."""
    counts = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    lengths = np.flatnonzero(counts)
    chosen: list[tuple[tuple[int, ...], int]] = []
    if columns := combinations(lengths, counts[lengths], window):
        x = least_squares(columns, counts.astype(float))
        for i in np.argsort(-x, kind="stable").tolist():
            pattern = columns[i]
            need = {a: pattern.count(a) for a in pattern}
            n = min(int(x[i] + 1e-6), *(int(counts[a]) // k for a, k in need.items()))
            if n > 0:
                chosen.append((pattern, n))
                for a, k in need.items():
                    counts[a] -= n * k
    left = [int(a) for a in np.flatnonzero(counts)]
    while left:
        pattern, need, space = [], {}, window
        while (k := bisect_right(left, space)) and space:
            while k and counts[left[k - 1]] <= need.get(left[k - 1], 0):
                k -= 1
            if not k:
                break
            a = left[k - 1]
            pattern.append(a)
            need[a] = need.get(a, 0) + 1
            space -= a
        n = min(int(counts[a]) // k for a, k in need.items())
        chosen.append((tuple(pattern), n))
        for a, k in need.items():
            counts[a] -= n * k
        left = [a for a in left if counts[a]]
    return chosen


def place(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    ``cut`` needs doc_id, start and length, at most ``window``, and should be a written table,
    as it is read three times. Its other columns stay. Offsets in a sequence have no gaps.
    The ranks of the pieces of one length are counted in as many parts as there are shuffle
    partitions, so a length that all copies of a document share is spread out.
    """
    spark = cut.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "doc_tokens", "ids_crc32"), F.lit(parts)))
    sizes = ranked.groupBy("length", "part").agg(F.count("*").alias("n"))
    total = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a window's worth of rows at most
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    order = W.partitionBy("length", "part").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    ranked = ranked.withColumn("rank", F.row_number().over(order) - 1).join(sizes, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))

    used: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int, int]]] = {}  # by length: first rank, its sequence, offset
    sequence = 0
    for pattern, n in plan(total, window):
        offset = 0
        for a in pattern:
            slots.setdefault(a, []).append((used.get(a, 0), sequence, offset))
            used[a] = used.get(a, 0) + n
            offset += a
        sequence += n
    tables = {a: tuple(np.array(x, np.int64) for x in zip(*s)) for a, s in slots.items()}
    shared = spark.sparkContext.broadcast(tables)  # a few rows per length up to the window

    @F.pandas_udf("sequence_id long, offset long")
    def seat(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for length, rank in batches:
            lengths, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
            out = np.zeros((2, len(lengths)), np.int64)
            for a in np.unique(lengths).tolist():
                of = lengths == a
                first, sequence, offset = known[a]
                i = np.searchsorted(first, ranks[of], "right") - 1
                out[0, of], out[1, of] = sequence[i] + ranks[of] - first[i], offset[i]
            yield pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    seated = ranked.withColumn("seat", seat(F.col("length"), F.col("rank")))
    return seated.select(*cut.columns, F.col("seat.sequence_id").alias("sequence_id"), F.col("seat.offset").alias("offset"))


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """Stage: all documents as pieces with their ids, sequence and offset."""
    cut = pieces(docs, window, vocabulary).withColumn("ids_crc32", F.crc32("ids"))
    return place(stage(cut, "pieces"), window)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return place(stage(cut, "pieces"))
