"""Codes of vectors by parts, fitted and searched in whole numbers.

Components become integers and vectors are cut into equal parts; each part
position has a codebook of a few entries, refined in rounds. Parts and entries
are padded with zeros to a power of two and go through an integer
Walsh-Hadamard transform, which keeps distances up to that power of two. Scaled
squared differences are summed in sequency order, from slow to fast sign
changes, and an entry is given up once its sum exceeds another entry's whole
distance. All of this is exact: int64 where the sizes allow it, Python's
integers beyond.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airq.sources.staging import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Sums travel in pieces of so many bits, so their total over any number of tasks fits a long.
LIMB = 32


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite numbers, for a scale that is a power of two."""
    if not values.size or np.abs(values).max() < 1 << 40:
        return np.floor(values * scale).astype(np.int64)
    exact = [math.floor(x * scale) if abs(x) < 1 << 52 else int(x) * scale for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def sequency_order(n: int) -> np.ndarray:
    """For each number of sign changes, the row of the Hadamard matrix of size ``n`` that has it."""
    gray = np.arange(n) ^ (np.arange(n) >> 1)
    out = np.zeros(n, np.int64)
    for _ in range(n.bit_length() - 1):
        out, gray = (out << 1) | (gray & 1), gray >> 1
    return out


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform along the last axis, a power of two long, in sequency order; twice gives n times the input."""
    shape, n, step = x.shape, x.shape[-1], 1
    while step < n:
        x = x.reshape(*shape[:-1], n // (2 * step), 2, step)
        x = np.stack((x[..., 0, :] + x[..., 1, :], x[..., 0, :] - x[..., 1, :]), -2)
        step *= 2
    return x.reshape(shape)[..., sequency_order(n)]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each transformed part the nearest transformed entry, the first of equals, and the scaled squared distance.

    A first stretch of coefficients is compared with all entries. The entry ahead then gets its whole
    distance; others go on while their sum does not exceed it.
    """
    n = rows.shape[1]
    done = max(1, n // 4)
    partial = ((rows[:, None, :done] - entries[None, :, :done]) ** 2).sum(2)
    ahead = partial.argmin(1)
    bound = partial[np.arange(len(rows)), ahead] + ((rows[:, done:] - entries[ahead, done:]) ** 2).sum(1)
    at, entry = np.nonzero((partial <= bound[:, None]).astype(bool))
    total = partial[at, entry]
    while done < n:
        to = min(n, 2 * done)
        total = total + ((rows[at, done:to] - entries[entry, done:to]) ** 2).sum(1)
        alive = (total <= bound[at]).astype(bool)
        at, entry, total, done = at[alive], entry[alive], total[alive], to
    if not len(at):
        return np.empty(0, np.int64), total
    heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    best = np.minimum.reduceat(total, heads)
    first = np.flatnonzero((total == best[at]).astype(bool))
    return entry[first[np.unique(at[first], return_index=True)[1]]], best


@dataclass
class Codebooks:
    """Entries as part, entry, position; ``width`` is the length of a part."""

    entries: np.ndarray
    width: int

    @property
    def padded(self) -> int:
        return 1 << max(0, self.width - 1).bit_length()

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def parts(self, vectors: pa.Array, parts: int = PARTS, scale: int = SCALE) -> np.ndarray:
        """Integer vectors as row, part, padded position; short vectors end in zeros."""
        sizes = np.diff(vectors.offsets.to_numpy())
        flat = integers(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), scale)
        whole = np.zeros((len(sizes), parts * self.width), flat.dtype)
        whole[np.arange(parts * self.width)[None, :] < sizes[:, None]] = flat
        out = np.zeros((len(sizes), parts, self.padded), flat.dtype)
        out[:, :, : self.width] = whole.reshape(len(sizes), parts, self.width)
        return out

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row by part: the nearest entry and the exact squared distance; and the transformed parts."""
        entries = np.zeros((*self.entries.shape[:2], self.padded), self.entries.dtype)
        entries[:, :, : self.width] = self.entries
        largest = max([abs(int(x)) for a in (vectors, entries) if a.size for x in (a.min(), a.max())], default=0)
        if (2 * largest * self.padded) ** 2 >= 1 << 62:
            vectors, entries = vectors.astype(object), entries.astype(object)
        else:
            vectors, entries = vectors.astype(np.int64), entries.astype(np.int64)
        rows, entries = transform(vectors), transform(entries)
        told = [nearest(rows[:, p], entries[p]) for p in range(len(entries))]
        return np.stack([t[0] for t in told], 1), np.stack([t[1] for t in told], 1) // self.padded, rows


def usable(vector: Column) -> Column:
    """True for vectors that are there and have neither null nor non-finite components."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


def limbs(n: int) -> list[tuple[int, int]]:
    """A whole number in signed pieces of ``LIMB`` bits: (place, piece)."""
    sign, rest, out = (-1 if n < 0 else 1), abs(n), []
    while rest:
        out.append((len(out), sign * (rest & ((1 << LIMB) - 1))))
        rest >>= LIMB
    return out


def refined(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: each entry becomes the floored mean of its parts; entries without parts stay.

    Tasks send sums of transformed parts, which are transformed back exactly; there are as many rows
    as codebook components.
    """
    parts, n_entries = books.entries.shape[:2]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, n_entries, books.padded), object), np.zeros((parts, n_entries), object)
        for batch in batches:
            index, _, rows = books.assign(books.parts(batch[0], parts))
            for p in range(parts):
                for e in range(n_entries):
                    own = index[:, p] == e
                    if own.any():
                        sums[p, e] += rows[own, p].sum(0).astype(object)
                        counts[p, e] += int(own.sum())
        out = [(p, e, i, *limb) for p in range(parts) for e in range(n_entries) for i, x in enumerate([*sums[p, e], counts[p, e]]) for limb in limbs(int(x))]
        names, kinds = ["part", "entry", "position", "place", "piece"], [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names)

    told = vectors.select("vector").mapInArrow(gather, "part int, entry int, position int, place int, piece long")
    total = np.zeros((parts, n_entries, books.padded + 1), object)
    for r in told.groupBy("part", "entry", "position", "place").agg(F.sum("piece").alias("piece")).collect():
        total[r["part"], r["entry"], r["position"]] += r["piece"] << (LIMB * r["place"])
    entries = books.entries.astype(object)
    back = transform(total[:, :, :-1])
    for p in range(parts):
        for e in range(n_entries):
            if n := total[p, e, -1]:
                entries[p, e] = [x // books.padded // n for x in back[p, e, : books.width]]
    return Codebooks(entries, books.width)


def fit(vectors: DataFrame, rounds: int = ROUNDS, n_entries: int = ENTRIES, parts: int = PARTS, scale: int = SCALE) -> Codebooks:
    """Codebooks of the rows (vec_id, vector), all of which count in every round.

    They start from the vectors of the smallest ids (null ids last, equal ids by their vectors), fewer if there
    are fewer rows. A round that changes nothing ends the work, as all later ones would do the same.
    """
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(n_entries).select("vector").collect()
    books = Codebooks(np.zeros((parts, 0, -(-width // parts)), np.int64), -(-width // parts))
    if first and width:
        start = books.parts(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), parts, scale)
        books = Codebooks(start[:, :, : books.width].swapaxes(0, 1), books.width)
        for _ in range(rounds):
            before, books = books, refined(vectors, books)
            if (before.entries == books.entries).all():
                break
    return books


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Adds ``code``, two hex digits a part, and ``error``, the squared distances of all parts; null if no long holds it."""
    parts = books.entries.shape[0]
    schema = T.StructType([f for f in vectors.schema if f.name != "vector"] + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    digits = [f"{i:02x}" for i in range(256)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if books.entries.size:
                index, distance, _ = books.assign(books.parts(batch["vector"], parts))
            else:  # only vectors without components
                index, distance = np.zeros((batch.num_rows, parts), np.int64), np.zeros((batch.num_rows, parts), np.int64)
            codes = ["".join([digits[i] for i in row]) for row in index.tolist()]
            errors = [e if (e := sum(row)) < 1 << 63 else None for row in distance.tolist()]
            others = [c for c, n in zip(batch.columns, batch.schema.names) if n != "vector"]
            yield pa.RecordBatch.from_arrays([*others, pa.array(codes, pa.string()), pa.array(errors, pa.int64())], schema.names)

    return vectors.mapInArrow(encode, schema)


def compress(table: DataFrame, vector: str = "embedding", **options) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error, label_error) of the usable vectors, as a written table, and the codebooks.

    Rows whose vector is null or has null or non-finite components are dropped. Vectors are as long as
    the longest, shorter ones end in zeros; so do the last parts if the length is no multiple of the
    parts. Repeated rows stay. ``label_error`` is the sum over equal labels, nulls together, null if no
    long holds it. An empty table gives no rows and no entries.
    """
    kept = stage(table.where(usable(F.col(f"`{vector}`"))).select("vec_id", "label", F.col(f"`{vector}`").cast("array<double>").alias("vector")), "vectors")
    books = fit(kept, **options)
    codes = stage(coded(kept, books), "codes")
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("error").isNull()).alias("beyond"))
    sums = sums.select("of", F.when(F.col("beyond") == 0, F.expr("try_cast(total AS bigint)")).alias("label_error"))
    return codes.join(stage(sums, "label-errors"), F.col("label").eqNullSafe(F.col("of")), "left").drop("of"), books


def query(spark, sf_dir: str) -> DataFrame:
    """Codes of all usable ``embeddings``; edge cases as ``compress`` says."""
    codes, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def _sql() -> str:
    distance = "(SELECT a.id, a.p, b.e, sum((a.x - b.x) * (a.x - b.x)) AS d FROM cells a JOIN books{0} b ON a.p = b.p AND a.i = b.i GROUP BY a.id, a.p, b.e)"
    told = "told{0} AS MATERIALIZED (SELECT id, p, arg_min(e, d * 16 + e) AS e, min(d) AS d FROM " + distance + " GROUP BY id, p)"
    books = """books{1} AS MATERIALIZED (SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM books{0} b LEFT JOIN (
      SELECT t.p, t.e, c.i, CAST((sum(c.x) - ((sum(c.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
      FROM told{0} t JOIN cells c ON t.id = c.id AND t.p = c.p GROUP BY t.p, t.e, c.i) m ON b.p = m.p AND b.e = m.e AND b.i = m.i)"""
    steps = [x.format(r, r + 1) for r in range(ROUNDS) for x in (told, books)] + [told.format(ROUNDS)]
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id AS id, label, embedding AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    cells AS MATERIALIZED (SELECT id, n // (len(v) // {PARTS}) AS p, n % (len(v) // {PARTS}) AS i, CAST(floor(CAST(v[n + 1] AS DOUBLE) * {SCALE}) AS BIGINT) AS x
      FROM (SELECT id, v, unnest(range(len(v))) AS n FROM kept)),
    books0 AS MATERIALIZED (SELECT p, e, i, x FROM cells JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS e FROM kept ORDER BY id LIMIT {ENTRIES}) USING (id)),
    {", ".join(steps)},
    codes AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d) AS error FROM told{ROUNDS} GROUP BY id)
    SELECT id AS vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM books{ROUNDS}) AS codebooks_sha256
    FROM codes JOIN kept USING (id)"""


#: Direct distances in place of the transform; the rounds written out one by one.
SQL = _sql()
