"""Nearest vectors by balanced posting lists.

A bounded sample is halved again and again, each time at the median between
two centres, until the parts are small: their means are centroids of lists of
like size. A graph of near centroids, held in memory, is walked from a few
entries to the centroids nearest a vector. A vector is written to the nearest
list and, if it lies near a border, to the next ones too. A query reads the
lists whose distance is within a ratio of the nearest one's. Both ratios are
fitted on the sample: of those that find ``GOAL`` of its neighbours, the pair
that reads least. No count bounds the lists of a vector or of a query; where all
that the walk kept is within the ratio, all centroids are measured. Lists side
by side form groups; a query travels once to a group, with the numbers of the
lists it reads there. Groups and queries meet block by block; scores are
computed on the original vectors in double precision.

Largest inner products become nearest distances by one more dimension, which
gives all vectors the same length and is zero for queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.llm.common import hash_share
from airq.sources.staging import stage

NEAREST = 20
#: Rows of a group of lists, and queries, that meet in one block.
BLOCK = 4096
#: Lists of a group.
SIDE = 16
#: Lists a query reads at least, so that one that lies on a centroid finds enough.
LEAST = 8
#: Share of the neighbours within the sample that the fitted ratios find.
GOAL = 0.98
#: Ratios tried for writing; those with more than ``COPIES`` lists a vector are left out, but for the first.
WRITE = (0.01, 0.02, 0.04, 0.08)
COPIES = 4.0


@dataclass(frozen=True)
class Lists:
    centroids: np.ndarray  # with the added dimension
    graph: np.ndarray  # per centroid, the numbers of near ones
    entries: np.ndarray
    longest: float  # the largest length of a vector, squared
    beam: int = 64
    write: float = WRITE[0]  # a vector is written to the lists within this ratio of its nearest
    read: float = 0.3  # a query reads the lists within this ratio of its nearest

    def apart(self, x: np.ndarray) -> np.ndarray:
        """Distances of the rows of x to all centroids."""
        c = self.centroids
        return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (c**2).sum(1)[None, :] - 2 * x @ c.T))

    def beyond(self, d: np.ndarray, nearest: np.ndarray) -> np.ndarray:
        """By which ratio distances exceed the nearest one."""
        return d / np.maximum(nearest, 1e-6 * np.sqrt(self.longest))[:, None] - 1


def halved(points: np.ndarray, most: int, seed: int = 7) -> np.ndarray:
    """Means of parts of at most ``most`` points, from halving at the median between two centres."""
    rng, todo, means = np.random.default_rng(seed), [np.arange(len(points))], []
    while todo:
        part = todo.pop()
        x = points[part]
        if len(part) <= most:
            means.append(x.mean(0))
            continue
        a, b = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(6):
            side = x @ (a - b) > 0.5 * (a @ a - b @ b)
            if side.all() or not side.any():
                break
            a, b = x[side].mean(0), x[~side].mean(0)
        order = np.argsort(x @ (a - b), kind="stable")
        todo += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return np.array(means)


def build(sample: np.ndarray, longest: float, per_list: int = 64, degree: int = 24) -> Lists:
    full = lengthened(sample, longest)
    centroids = halved(full, per_list)
    d = ((centroids**2).sum(1)[:, None] + (centroids**2).sum(1)[None, :]) - 2 * centroids @ centroids.T
    np.fill_diagonal(d, np.inf)
    k = min(degree, len(centroids) - 1)
    near = np.argpartition(d, k - 1, 1)[:, :k] if k > 0 else np.zeros((len(centroids), 0), np.int64)
    far = np.random.default_rng(11).integers(0, len(centroids), (len(centroids), 4))  # long ways through the graph
    entries = np.unique(np.linspace(0, len(centroids) - 1, 16).astype(np.int64))
    return Lists(centroids, np.concatenate((near, far), 1), entries, longest)


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    return np.concatenate((x, np.sqrt(np.maximum(0, longest - (x**2).sum(1)))[:, None]), 1)


def walk(lists: Lists, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroids of each row of q found by walking the graph, nearest first, and their distances."""
    c, n, beam = lists.centroids, len(q), min(lists.beam, len(lists.centroids))
    norms, rows = (c**2).sum(1), np.arange(len(q))[:, None]
    own = (q**2).sum(1)[:, None]

    def distance(ids):
        return np.maximum(0, own + norms[ids] - 2 * np.einsum("nkd,nd->nk", c[ids], q))

    ids = np.repeat(lists.entries[None, :], n, 0)
    d, done = distance(ids), np.zeros(ids.shape, bool)
    while True:
        order = np.argsort(d, 1, kind="stable")[:, :beam]
        ids, d, done = ids[rows, order], d[rows, order], done[rows, order]
        open_ = np.where(done, np.inf, d)
        if not np.isfinite(open_).any():
            return ids, np.sqrt(d)
        step = np.argsort(open_, 1, kind="stable")[:, :4]
        go = np.isfinite(open_[rows, step])
        done[rows, step] |= go
        new = lists.graph[ids[rows, step]].reshape(n, -1)
        dn = np.where(np.repeat(go, lists.graph.shape[1], 1), distance(new), np.inf)
        ids, d = np.concatenate((ids, new), 1), np.concatenate((d, dn), 1)
        done = np.concatenate((done, np.zeros(new.shape, bool)), 1)
        # Of a centroid that is there twice, the first stays, which knows whether it was visited.
        order = np.argsort(np.where(np.isfinite(d), ids, len(c)), 1, kind="stable")
        by_id = ids[rows, order]
        twice = np.zeros(ids.shape, bool)
        twice[rows, order[:, 1:]] = by_id[:, 1:] == by_id[:, :-1]
        d = np.where(twice, np.inf, d)
        done |= ~np.isfinite(d)


def fitted(lists: Lists, sample: np.ndarray, k: int, asked: int = 512, seen: int = 4096) -> Lists:
    """With the ratios that find ``GOAL`` of the k nearest neighbours, within the sample, of ``asked`` of its rows and read least.

    A sample is thinner than the table, so its neighbours lie further apart than the table's.
    """
    spread = lambda n: np.unique(np.linspace(0, len(sample) - 1, n).astype(np.int64))
    rows, n = spread(asked), min(k, len(sample) - 1)
    if n < 1:
        return lists
    score = sample[rows] @ sample.T
    score[np.arange(len(rows)), rows] = -np.inf
    top = np.argpartition(-score, n - 1, 1)[:, :n]
    far = lists.apart(asking(sample[rows]))
    ratio = lists.beyond(far, far.min(1))
    ratio[np.arange(len(rows))[:, None], np.argsort(far, 1, kind="stable")[:, :LEAST]] = 0
    some = lists.apart(lengthened(sample[spread(seen)], lists.longest))
    best = None
    for write in WRITE:
        share = (lists.beyond(some, some.min(1)) <= write).mean(0)
        if best and share.sum() > COPIES:
            break
        need = []
        for a in range(0, len(rows), 32):
            d = lists.apart(lengthened(sample[top[a : a + 32].ravel()], lists.longest))
            held = (lists.beyond(d, d.min(1)) <= write).reshape(-1, n, d.shape[1])
            need.append(np.where(held, ratio[a : a + 32, None, :], np.inf).min(2))
        read = float(np.quantile(np.concatenate(need), GOAL, method="higher"))
        cost = ((ratio <= read) @ share).mean()
        if best is None or cost < best[0]:
            best = (cost, write, read)
    return replace(lists, write=best[1], read=best[2])


def asking(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x, np.zeros((len(x), 1))), 1)


def lists_of(lists: Lists, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, list): the lists that each row of x is written to, or reads."""
    ratio, least = (lists.read, LEAST) if query else (lists.write, 1)
    x = asking(x) if query else lengthened(x, lists.longest)
    ids, d = walk(lists, x)
    take = (lists.beyond(d, d[:, 0]) <= ratio) & np.isfinite(d)
    more = take.all(1) & (d.shape[1] < len(lists.centroids))  # all that the walk kept is near enough, so others may be
    take[:, :least] = np.isfinite(d[:, :least])
    row, col = np.nonzero(take & ~more[:, None])
    rest = np.flatnonzero(more)
    full = lists.apart(x[rest])
    near = np.minimum(full.min(1), d[rest, 0]) if len(rest) else np.zeros(0)
    extra, number = np.nonzero(lists.beyond(full, near) <= ratio)
    return np.concatenate((row, rest[extra])), np.concatenate((ids[row, col], number))


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part: not null, not zero, all components there and finite."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def listed(rows: DataFrame, lists: Lists, query: bool) -> DataFrame:
    """Each row once for every group of lists it is written to, or reads from, with the numbers of those lists."""
    shared = rows.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                row, number = lists_of(index, np.stack(part["v"].to_numpy(zero_copy_only=False)), query)
                order = np.lexsort((number, row))
                row, number = row[order], number[order]
                first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (number[1:] // SIDE != number[:-1] // SIDE))))
                ends = pa.array(np.append(first, len(row)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[first] // SIDE, pa.int64()), part["vec_id"].take(row[first]), part["v"].take(row[first]), pa.ListArray.from_arrays(ends, pa.array(number, pa.int64()))],
                    ["side", "vec_id", "v", "lists"],
                )

    return rows.select("vec_id", "v").mapInArrow(run, "side long, vec_id long, v array<double>, lists array<long>")


def expanded(lists: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(list, row) of the rows' lists, by list, then row."""
    number, row = np.concatenate(lists.to_numpy()), np.repeat(np.arange(len(lists)), lists.str.len())
    order = np.lexsort((row, number))
    return number[order], row[order]


def best_of_block(vs: pd.DataFrame, qs: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query_id, vec_id, score): of each query the k best rows of the lists it reads, ties to the smaller id."""
    v, q, ids = np.stack(vs["v"].to_numpy()), np.stack(qs["v"].to_numpy()), vs["vec_id"].to_numpy(np.int64)
    (v_list, v_row), (q_list, q_row) = expanded(vs["lists"]), expanded(qs["lists"])
    bound = np.full(len(q), -np.inf)  # k rows or more have at least this score
    rows, cols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for number in np.intersect1d(v_list, q_list):
        mine = v_row[slice(*np.searchsorted(v_list, (number, number + 1)))]
        readers = q_row[slice(*np.searchsorted(q_list, (number, number + 1)))]
        for a in range(0, len(readers), 256):
            who = readers[a : a + 256]
            rough = q[who] @ v[mine].T
            if len(mine) > k:
                bound[who] = np.maximum(bound[who], np.partition(rough, len(mine) - k, 1)[:, len(mine) - k])
            least = bound[who]
            row, col = np.nonzero(rough >= np.where(np.isfinite(least), least - 1e-9 * np.maximum(1.0, np.abs(least)), -np.inf)[:, None])
            rows.append(who[row])
            cols.append(mine[col])
    row, col = np.divmod(np.unique(np.concatenate(rows) * len(v) + np.concatenate(cols)), len(v))  # a vector may be in several lists
    score = np.concatenate([np.zeros(0)] + [(v[col[a : a + BLOCK]] * q[row[a : a + BLOCK]]).sum(1) for a in range(0, len(row), BLOCK)])  # the same for a pair in whatever block
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return pd.DataFrame({"query_id": qs["vec_id"].to_numpy(np.int64)[row[keep]], "vec_id": ids[col[keep]], "score": score[keep]})


def search(vectors: DataFrame, chosen, k: int = NEAREST, sample: int = 20_000) -> DataFrame:
    """(query_id, rank, vec_id, score): of each valid vector for which ``chosen`` holds, the k nearest others found.

    The index is fit on about ``sample`` vectors chosen by hash, a list for 32 to 64 of them, and holds every valid vector. Equal vectors
    are searched once; of them the k + 1 smallest ids are all that can be among the k nearest. Rows that
    repeat an id with the same vector count once. Vectors of different lengths are compared with those of the most
    frequent length only; the others take no part. An empty table has no rows.
    """
    spark = vectors.sparkSession
    rows = valid(vectors)
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    out = "query_id long, rank int, vec_id long, score double"
    if dims is None:
        return spark.createDataFrame([], out)
    key = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit("second"), "v").alias("k2")]
    rows = rows.where(F.size("v") == dims["dim"]).select("vec_id", "v", *key)
    # The smallest ids of each vector, first in parts of a group, then of the group.
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    few = rows.dropDuplicates(["vec_id", "k1", "k2"]).withColumn("r", F.row_number().over(W.partitionBy("k1", "k2", part).orderBy("vec_id"))).where(F.col("r") <= k + 1)
    few = stage(few.withColumn("r", F.row_number().over(W.partitionBy("k1", "k2").orderBy("vec_id"))).where(F.col("r") <= k + 1).select("vec_id", "v", "r"), "vectors")
    facts = few.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("longest")).first()
    drawn = few.where(hash_share(sample, F.lit(facts["n"]), "vec_id")).select("vec_id", "r", "v").toPandas().sort_values(["vec_id", "r"])["v"]  # about ``sample`` vectors
    drawn = np.stack(drawn.to_numpy()) if len(drawn) else np.stack(few.limit(1).toPandas()["v"].to_numpy())
    lists = fitted(build(drawn, facts["longest"]), drawn, k)

    posted = stage(listed(few, lists, False), "postings")
    asked = rows.where(chosen).groupBy("k1", "k2").agg(F.min("vec_id").alias("vec_id"))
    questions = rows.join(asked.select("vec_id", F.col("k1").alias("a1"), F.col("k2").alias("a2")), "vec_id").where((F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")))
    questions = stage(listed(questions.dropDuplicates(["vec_id", "k1", "k2"]), lists, True), "questions")
    sizes = {c: {r["side"]: -(-r["n"] // BLOCK) for r in df.groupBy("side").agg(F.count("*").alias("n")).collect()} for c, df in (("v", posted), ("q", questions))}  # a row per group of lists

    def blocks(mine: str, other: str, name: str):
        """Which blocks a row of a group belongs to: its own by hash, with every block of the other side."""
        own = F.create_map(*[F.lit(x) for p in (sizes[mine] or {0: 1}).items() for x in p])[F.col("side")]
        others = F.coalesce(F.create_map(*[F.lit(x) for p in (sizes[other] or {0: 1}).items() for x in p])[F.col("side")], F.lit(0))
        place = F.pmod(F.xxhash64("vec_id", F.lit(name)), own)
        return place.alias(f"b_{mine}"), F.explode(F.when(others > 0, F.sequence(F.lit(0).cast("long"), others.cast("long") - 1)).otherwise(F.array().cast("array<long>"))).alias(f"b_{other}")

    left = posted.select("side", "vec_id", "v", "lists", *blocks("v", "q", "row"))
    right = questions.select("side", "vec_id", "v", "lists", *blocks("q", "v", "question"))

    def meet(key, vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not len(vs) or not len(qs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        return best_of_block(vs, qs, k + 1)

    group = ["side", "b_v", "b_q"]
    pairs = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = pairs.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    # Each query gets what was found for its vector, without itself.
    same = rows.where(chosen).select(F.col("vec_id").alias("own"), "k1", "k2").distinct()
    each = same.join(asked.withColumnRenamed("vec_id", "query_id"), ["k1", "k2"]).join(best, "query_id").where("own <> vec_id")
    last = W.partitionBy("own").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select(F.col("own").alias("query_id"), "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
