"""Resampling by importance against a plain version, on long texts cut in parts, and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airq.llm import resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_runs(text, longest=2):
    words = WORD.findall((text or "").encode().lower())
    return len(words), [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target):
    def count(texts):
        return Counter(zlib.crc32(run) % 10000 for t in texts for run in plain_runs(t)[1])

    s, t = count(x for _, x in docs), count(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        n, runs = plain_runs(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in (zlib.crc32(r) % 10000 for r in runs)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    ranks = {}
    for rank, r in enumerate(eligible[: 25 * len(eligible) // 100], 1):
        ranks.setdefault((r[0], *r[2:]), []).append(rank)
    return sorted(((i, f, w, s, ranks[i, f, w, s].pop(0) if ranks.get((i, f, w, s)) else None) for i, n, f, w, s in out), key=str)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_the_plain_version(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    got = resampling.query(spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, target)


def test_edges(spark, edge, empty):
    texts = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    more = [(100 + i, " ".join(f"Word{(i * j) % 7} a{j}b" for j in range(15))) for i in range(12)] * 2
    rows = edge.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    target = spark.createDataFrame([("word1 a2b word2",), (None,), ("",)], "text string")
    got = resampling.resample(rows, target, ["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, got.collect()), key=str) == plain(texts + more, ["word1 a2b word2", None, ""])
    assert resampling.resample(empty, target).count() == 0
    nothing = resampling.resample(rows, target.where(F.lit(False)), ["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, nothing.collect()), key=str) == plain(texts + more, [])


def test_columns_with_clashing_names(spark, docs):
    rows = docs([(i, "the same words again and again " * 5, "en") for i in range(8)])
    rows = rows.withColumns({"weight": F.lit("x"), "rank": F.lit("y"), "part": F.lit(3), "body": F.lit(4)})
    target = spark.createDataFrame([("words",)], "text string")
    got = resampling.resample(rows, target)
    assert set(got.columns) == set(rows.columns) | {"n_words", "n_features", "weight", "score", "rank"} and len(got.columns) == len(set(got.columns))
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2] and {r["part"] for r in got.collect()} == {3}


@pytest.mark.parametrize("most", [1, 7, 50, 1000])
@pytest.mark.parametrize("longest", [1, 2, 3])
def test_parts_of_long_texts_lose_no_run(most, longest):
    rng = np.random.default_rng(most)
    text = "".join(rng.choice(list("ab  \n.é漢\x00Z"), 400)) + "q" * 90 + "  " * 50
    texts = pa.array([None, text, "", "short one", text], pa.string())
    words, runs = np.zeros(5, int), Counter()
    for a, b, part, seen in resampling.parts_of(texts, longest, most):
        counts, levels = resampling.runs_of(part, seen, longest)
        words[a:b] += counts
        for bucket, owner in levels:
            runs.update(zip((a + owner).tolist(), bucket.tolist()))
    whole = [plain_runs(t, longest) for t in texts.to_pylist()]
    assert words.tolist() == [n for n, _ in whole]
    assert runs == Counter((i, zlib.crc32(r) % 10000) for i, (_, rs) in enumerate(whole) for r in rs)
