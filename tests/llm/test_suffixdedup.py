"""Removal of long repeats against plain comparison of all strings, block by block and string by string, and on edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airq.llm import suffixdedup

SF = "/root/testdata/sf0.001"


def covered(texts, length):
    """For each text its bytes and which of them go."""
    raw = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        marks, upto = bytearray(len(b)), 0
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                for j in range(max(i, upto), i + length):
                    marks[j] = 1
                upto = i + length
        out.append((b, marks))
    return out


def plain(texts, length):
    out = []
    for b, marks in covered(texts, length):
        kept = bytes(x for x, m in zip(b, marks) if not m)
        out.append((len(b), sum(marks), sum(1 for run in bytes(marks).split(b"\0") if run), hashlib.sha256(kept).hexdigest()))
    return out


def told(docs, **options):
    cut = suffixdedup.removals(docs, **options)
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    c1, c2 = suffixdedup.text_class(body)
    rows = docs.select("n", F.octet_length(body).alias("n_bytes"), F.sha2(body, 256).alias("own"), c1.alias("c1"), c2.alias("c2")).join(cut, ["c1", "c2"], "left")
    got = rows.select("n", "n_bytes", F.coalesce("n_removed", F.lit(0)), F.coalesce(F.size("spans"), F.lit(0)), F.coalesce("kept_sha256", "own")).orderBy("n").collect()
    return [tuple(r)[1:] for r in got]


def as_symbols(texts):
    return [np.frombuffer(t, np.uint8).astype(np.int64) for t in texts]


@pytest.mark.parametrize("letters", [b"ab", b"abc\x00\xff", b"a"])
def test_suffixes_are_sorted(letters):
    rng = random.Random(len(letters))
    for _ in range(150):
        texts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 9))]
        rest, shared, row = suffixdedup.sorted_pieces(as_symbols(texts))
        suffixes = sorted({t[i:] for t in texts for i in range(len(t) + 1)})
        place = {s: i for i, s in enumerate(suffixes)}
        assert len(rest) == len(shared) == len(suffixes) and row.tolist() == [place[t] for t in texts]
        assert rest[1:].tolist() == [place[s[1:]] for s in suffixes[1:]]
        common = [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(suffixes, suffixes[1:])]
        assert shared[1:].tolist() == common
        length = rng.randint(1, 5)
        counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
        assert [f.tolist() for f in suffixdedup.repeated_starts(as_symbols(texts), length)] == [[i for i in range(len(t) - length + 1) if counts[t[i : i + length]] > 1] for t in texts]


@pytest.mark.parametrize("length,gram", [(12, 5), (9, 8), (30, 7)])
def test_pieces_cover_each_start_once_and_equal_strings_share_an_anchor(length, gram):
    rng = random.Random(length)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 5, length - 1, length, 80]))) for _ in range(12)]
    texts += [b"a" * 60, texts[4] + texts[5]]
    raw, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    of, first, size, place, key = suffixdedup.Anchors(length, gram).pieces(raw, ends)
    strings = {}
    for t, a, n, at, k in zip(of.tolist(), (first - np.concatenate(([0], ends))[of]).tolist(), size.tolist(), place.tolist(), key.tolist()):
        for i in range(a, a + n):
            assert i <= a + at <= i + length - gram
            strings.setdefault(texts[t][i : i + length], []).append((t, i, k, a + at - i))
    assert sorted((t, i) for s in strings.values() for t, i, _, _ in s) == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - length + 1)]
    assert all(len({x[2:] for x in s}) == 1 for s in strings.values())


def many_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [word() for _ in range(rng.randint(0, 20))]
        if rng.random() < 0.7:
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            parts.insert(rng.randint(0, len(parts)), p[a : a + rng.randint(20, 150)])
        texts.append(" ".join(parts))
    texts += [texts[3]] * 3 + [texts[5] + "x", "ab" * 200, "q" * 100, "漢字" * 40, None, "", None, "same " * 30 + passages[0]]
    return texts


@pytest.mark.parametrize("options", [
    {"grams": (20, 36)}, {"grams": (36,)}, {"grams": (5, 20, 39), "block_symbols": 1}, {"grams": (20, 36), "block_pieces": 1}, {"grams": (10,), "block_pieces": 3},
])
def test_equals_plain_comparison(spark, options):
    texts = many_texts(len(str(options)))
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    assert told(docs, length=40, **options) == plain(texts, 40)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "PART_BYTES", 64)
    texts = many_texts(9) + ["".join(t for t in many_texts(9) if t)]
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    assert told(docs, length=40, grams=(20, 36)) == plain(texts, 40)


@pytest.mark.parametrize("sf", [SF])
def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: p for r, p in zip(rows, plain([r["text"] for r in rows], 400))}
    got = suffixdedup.query(spark, sf)
    assert got.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {r["doc_id"]: tuple(r)[1:5] for r in got.collect()} == want


def test_edges(spark, edge, empty):
    kept = suffixdedup.keep_unrepeated(edge).collect()
    assert suffixdedup.keep_unrepeated(edge).columns == edge.columns and len(kept) == edge.count()
    by_id = {(r["doc_id"], r["lang"], len(r["text"] or "")) for r in kept}
    assert (6, "fr", 0) in by_id and (7, None, 0) in by_id and (2, "en", 0) in by_id and (5, "en", 16) in by_id
    assert {r["text"] for r in kept if r["doc_id"] == 1} == {None}
    assert suffixdedup.keep_unrepeated(empty).count() == 0 and suffixdedup.removals(empty).count() == 0


def test_cut_characters_are_replaced(spark):
    texts = ["é" * 30 + "end", "x" + "é" * 29 + "tail"]
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    kept = [r["text"] for r in suffixdedup.keep_unrepeated(docs, length=41, grams=(20,)).orderBy("n").collect()]
    assert kept == [bytes(x for x, m in zip(b, marks) if not m).decode("utf-8", "replace") for b, marks in covered(texts, 41)]
