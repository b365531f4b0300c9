"""Codes of vectors against plain integers, with ties, huge components and edge cases."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airq.llm import vectorcodes

KIND = "vec_id long, embedding array<double>, label int, code int, part string, vector string"


def plain(rows, rounds=6, n_entries=16, parts=8):
    """Codes, errors and codebooks in Python's integers, rows (vec_id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    # Fractions of two integers keep 4096 * x exact at any size.
    whole = [[x.as_integer_ratio()[0] * 4096 // x.as_integer_ratio()[1] for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:n_entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def assign():
        return [[min(((sum((a - b) ** 2 for a, b in zip(v[p], e)), k) for k, e in enumerate(books[p])), default=(0, 0)) for p in range(parts)] for v in cut]

    for _ in range(rounds):
        told = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p] for v, t in zip(cut, told) if t[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    told, sums = assign(), defaultdict(int)
    errors = [sum(d for d, _ in t) for t in told]
    for r, e in zip(kept, errors):
        sums[r[2]] += e
    long = lambda n: n if n < 1 << 63 else None
    beyond = {r[2] for r, e in zip(kept, errors) if long(e) is None}
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in t), long(e), None if r[2] in beyond else long(sums[r[2]])) for r, t, e in zip(kept, told, errors)), key=str), sha


def compared(spark, rows, **options):
    table = spark.createDataFrame([(i, v, label, 1, "p", "v") for i, v, label in rows], KIND)
    codes, books = vectorcodes.compress(table, **options)
    return sorted((tuple(r) for r in codes.select("vec_id", "code", "error", "label_error").collect()), key=str), books.sha256


@pytest.mark.parametrize("n", [1, 2, 4, 8, 32])
def test_transform(n):
    walsh = vectorcodes.transform(np.eye(n, dtype=np.int64))
    assert [int((np.diff(row) != 0).sum()) for row in walsh] == list(range(n))
    x = np.random.default_rng(n).integers(-1000, 1000, (5, n))
    assert (vectorcodes.transform(vectorcodes.transform(x)) == n * x).all()
    assert ((vectorcodes.transform(x) ** 2).sum(1) == n * (x**2).sum(1)).all()


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("n", [1, 2, 8, 64])
def test_nearest_keeps_ties_and_distances(n, kind):
    rng = np.random.default_rng(n)
    rows, entries = rng.integers(-3, 4, (300, n)), rng.integers(-3, 4, (9, n))
    entries[5] = entries[2]
    a, b = vectorcodes.transform(rows).astype(kind), vectorcodes.transform(entries).astype(kind)
    index, total = vectorcodes.nearest(a, b)
    full = ((rows[:, None] - entries[None]) ** 2).sum(2)
    assert index.tolist() == full.argmin(1).tolist() and (total // n).astype(int).tolist() == full.min(1).tolist()


@pytest.mark.parametrize("dims", [8, 24, 64, 13])
def test_equals_plain_integers(spark, dims):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(0, 1) if dims != 24 else float(rng.randint(-1, 1)) for _ in range(dims)], rng.choice([1, 2, None])) for i in range(90)]
    rows += rows[:5]
    assert compared(spark, rows) == plain(rows)


def test_edges(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.randint(-8, 306) for _ in range(16)], i % 3) for i in range(40)]
    rows += [(50, None, 1), (51, [1.0, None] * 8, 1), (52, [math.nan] * 16, 1), (53, [math.inf] + [0.0] * 15, 1), (None, [0.5] * 16, None), (None, [0.5] * 16, None), (54, [], 7), (55, [2.0], 7), (7, [0.0] * 16, 9)]
    assert compared(spark, rows) == plain(rows)
    few = [(2, [1.0] * 8, 1), (1, [2.0] * 8, 1)]
    assert compared(spark, few) == plain(few)
    assert compared(spark, [(1, [], 3), (2, None, 3)]) == ([(1, "00" * 8, 0, 0)], hashlib.sha256(b"").hexdigest())
    assert compared(spark, []) == ([], hashlib.sha256(b"").hexdigest())


def test_query_columns(spark):
    got = vectorcodes.query(spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")]
    assert got.where(F.length("code") != 16).count() == 0
