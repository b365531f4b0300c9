"""Target-distribution importance resampling over hashed word runs.

Each word run falls into a bucket by its CRC. What a bucket gains is the log
ratio of its shares in the target texts and in the corpus; a document's weight
is the mean gain of its runs. Documents are drawn without replacement by the
weight plus Gumbel noise that depends on the document's id alone, so the
highest sums are a sample in proportion to the exponential of the weights.

Texts are handled by Arrow kernels: lowered, split by a pattern, flattened and
dictionary-encoded. Runs are pairs of a shorter run's number and the next
word's number, taken from shifted index arrays; only distinct runs are hashed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airq.llm.common import fresh
from airq.llm.sharding import ranked
from airq.sources.staging import stage

#: Fixed value: what separates words; letters are lowered before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, LONGEST = 10_000, 2
#: Bytes of text handled at once inside a task; longer texts are cut between words.
PART_BYTES = 1_000_000

_separator = re.compile(SEPARATORS.encode())


def cut_text(raw: bytes, carry: int, most: int = PART_BYTES) -> Iterator[tuple[bytes, int]]:
    """Parts of a lowered text and how many of their first words, ``carry`` at most, also ended the part before."""
    words, at = [], 0
    while at < len(raw):
        found = _separator.search(raw, at + most)
        end = found.start() if found else len(raw)
        part = b" ".join([*words, raw[at:end]])
        yield part, len(words)
        if carry:
            # The last words of the part, looked for in ever longer tails.
            tail = 64 * carry
            while len(last := [w for w in _separator.split(part[-tail:]) if w]) <= carry and tail < len(part):
                tail *= 4
            words = last[-carry:]
        at = end


def runs_of(texts: pa.Array, seen: int = 0, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words per text, and for each run length the buckets of all runs with their texts' numbers, in order.

    Runs that lie within the first ``seen`` words, of all texts together, are left out, and so are these words.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    filled = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(filled).dictionary_encode()
    word, owner = coded.indices.to_numpy().astype(np.int64), owner.filter(filled).to_numpy()
    known = coded.dictionary.cast(pa.binary()).to_pylist()
    counts = np.bincount(owner[seen:], minlength=len(texts))
    run, crc, starts, out = word, list(map(zlib.crc32, known)), np.arange(len(word)), []
    for n in range(1, longest + 1):
        if n > 1:
            inside = starts + n - 1 < len(word)
            inside[inside] = owner[starts[inside] + n - 1] == owner[starts[inside]]
            starts, run = starts[inside], run[inside]
            distinct, run = np.unique(run * len(known) + word[starts + n - 1], return_inverse=True)
            before, last = np.divmod(distinct, max(1, len(known)))
            head = [zlib.crc32(b" ", c) for c in crc]
            crc = [zlib.crc32(known[j], head[i]) for i, j in zip(before.tolist(), last.tolist())]
        new = starts + n > seen
        bucket = np.array(crc, np.int64) % buckets
        out.append((bucket.take(run[new]), owner[starts[new]]))
    return counts, out


def parts_of(texts: pa.Array, longest: int, most: int = PART_BYTES) -> Iterator[tuple[int, int, pa.Array, int]]:
    """Runs of rows (from, to) with their texts and 0; a long text comes alone, in parts with its number of words seen."""
    sizes = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > most:
            yield start, i, texts[start:i], 0
            start, size = i, 0
        size += n
        if n > most:
            for part, seen in cut_text(texts[i].as_buffer().to_pybytes().lower(), longest - 1, most):
                yield i, i + 1, pa.array([part], pa.binary()).cast(pa.string()), seen
            start, size = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes), texts[start:], 0


def bucket_counts(texts: DataFrame, column: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many word runs of all texts fall into each bucket; one row per bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, part, seen in parts_of(batch[0], longest):
                for bucket, _ in runs_of(part, seen, longest, buckets)[1]:
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    counted = texts.where(F.col(column).isNotNull()).select(column).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of each bucket's smoothed shares in the target and in the corpus, floored."""
    n, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, keep: list[str], longest: int = LONGEST) -> DataFrame:
    """The columns ``keep`` with ``n_words``, ``n_features`` and ``weight``: the floored mean gain of a text's runs.

    Null, empty and blank texts have no runs and weight 0. Columns of the three names are replaced.
    """
    names = ["n_words", "n_features", "weight"]
    keep = [c for c in keep if c.lower() not in names]
    kept = [docs.schema[c] for c in keep]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for a, b, part, seen in parts_of(batch[0], longest):
                counts, levels = runs_of(part, seen, longest, len(gain))
                words[a:b] += counts
                for bucket, owner in levels:
                    if len(owner):
                        heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                        total[a + owner[heads]] += np.add.reduceat(gain.take(bucket), heads)
                        features[a:b] += np.bincount(owner, minlength=b - a)
            mean = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, (words, features, mean))], [*keep, *names])

    schema = T.StructType([*kept, *[T.StructField(n, T.LongType()) for n in names]])
    body, = fresh(docs, "body")
    return docs.select(F.col("text").alias(body), *[F.col(f"`{c}`") for c in keep]).mapInArrow(weigh, schema)


def noise(doc_id: str, seed: int = 7):
    """1000 times a Gumbel number made from the seed and the id, floored; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(weights: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """Adds ``score`` and ``rank``: 1, 2, 3... for the drawn rows, null for the others.

    Of the N rows of ``least_words`` words or more, the floor(percent * N / 100) of highest
    score are drawn; ties go to the smaller doc_id (null ids first), rows equal in both are
    interchangeable. Rows are ordered by range partitions, and rows that repeat are spread by
    their place, so no group lies in one task. An empty table has no rows.
    """
    columns = [c for c in weights.columns if c.lower() not in ("score", "rank")]
    scored = weights.withColumn("score", F.col("weight") + noise("doc_id", seed))
    # The row goes as one column, so its names cannot meet those used here.
    table = scored.select(F.struct(*[F.col(f"`{c}`") for c in [*columns, "score"]]).alias("row"), (F.col("n_words") < least_words).alias("short"), (-F.col("score")).alias("down"), F.col("doc_id").alias("id"))
    table = stage(table.withColumn("place", F.monotonically_increasing_id()), "scores")
    n = table.where(~F.col("short")).count()
    placed, _ = ranked(table, ["short", "down", "id", "place"])
    drawn = ~F.col("short") & (F.col("rank") < percent * n // 100)
    return placed.select(*[F.col("row")[c].alias(c) for c in [*columns, "score"]], F.when(drawn, F.col("rank") + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, keep: list[str] | None = None, longest: int = LONGEST, buckets: int = BUCKETS, **options) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, n_features, weight, score and rank; see ``weighted`` and ``draw``.

    ``target`` has the wanted distribution's texts in ``text``. Counts cover all rows of both.
    """
    keep = docs.columns if keep is None else keep
    gain = gains(bucket_counts(docs, longest=longest, buckets=buckets), bucket_counts(target, longest=longest, buckets=buckets))
    return draw(weighted(docs, gain, keep, longest), **options)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document with its weight for the texts of ``benchmark``, and its place in the draw of 25 %.

    No rows for an empty table; null, empty and repeated rows as ``resample`` says.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return resample(docs, target, ["doc_id"]).select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
