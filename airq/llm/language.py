"""Language identification by bit-sliced Bloom filters.

Every slot of the filter holds one bit per language. The slots of an n-gram,
combined by AND, are the set of all languages that contain it, read at once.
A text's n-grams are looked up, the hits are counted per language, the hits
that the filter's fill explains by chance are taken off, and the language with
most hits left is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airq.llm.common import chunks, fold, fresh, hash_share, mix

GRAMS = (3, 4)
PROBES = 3
#: Characters handled at once inside a task; longer texts are cut.
CHARS = 250_000
#: Bits of a mask that are used; more languages take more mask words.
BITS = 62
UNKNOWN = "und"


def letters() -> np.ndarray:
    """True at the code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def points_of(text: str, is_letter: np.ndarray) -> np.ndarray:
    """The code points of a lowered text; runs of other characters than letters are one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = is_letter[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    return np.where(letter, points, np.uint32(32))[kept]


def hashed(points: np.ndarray, owner: np.ndarray, seen: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams with their owner, but those that end before ``seen``.

    The first character of an n-gram may be the space before a text, the others belong to one text;
    those with a space in second place are left out.
    """
    found, of = [], []
    for n in GRAMS:
        first = max(0, seen - n + 1)
        if len(points) - first < n:
            continue
        part, belongs = points[first:].astype(np.uint64), owner[first:]
        many = len(part) - n + 1
        own = (belongs[1 : many + 1] == belongs[n - 1 :]) & (part[1 : many + 1] != 32)
        h = np.full(many, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + part[j : many + j]
        found.append(mix(h[own]))
        of.append(belongs[1 : many + 1][own])
    return (np.concatenate(found), np.concatenate(of)) if found else (np.empty(0, np.uint64), np.empty(0, np.int32))


def grams_of(texts: list, is_letter: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the n-grams of the texts and their texts' numbers, in parts of bounded size.

    Texts are lowered; every run of other characters than letters counts as one space, and a space
    stands before and after each text. A long text is cut, behind another character than a letter where
    there is one, and its parts overlap by what an n-gram needs.
    """
    space, carry = np.full(1, 32, np.uint32), max(GRAMS) - 1
    for a, b in chunks(texts, CHARS):
        if b - a > 1 or len(texts[a] or "") <= CHARS:
            parts = [np.concatenate((points_of(t or "", is_letter), space)) for t in texts[a:b]]
            # A text that ends in a space needs no other.
            parts = [p[:-1] if len(p) > 1 and p[-2] == 32 else p for p in parts]
            owner = np.repeat(np.arange(a - 1, b, dtype=np.int32), [1, *map(len, parts)])
            yield hashed(np.concatenate((space, *parts)), owner)
            continue
        text, at, before = texts[a], 0, space
        while at < len(text):
            end = min(len(text), at + CHARS)
            if end < len(text):
                end = next((i for i in range(end, max(at, end - 1000), -1) if not is_letter[ord(text[i - 1])]), end)
            new = points_of(text[at:end], is_letter)
            if before[-1] != 32 and not is_letter[ord(text[at])]:
                new = np.append(space, new)
            points = np.concatenate((before, new))
            if end == len(text) and points[-1] != 32:
                points = np.append(points, space)
            owner = np.full(len(points), a, np.int32)
            owner[0] -= at == 0
            yield hashed(points, owner, len(before))
            before, at = points[-carry:], end


@dataclass(frozen=True)
class LanguageFilter:
    langs: list[str]
    masks: np.ndarray  # mask word, slot
    chance: np.ndarray  # per language, the share of foreign n-grams that hit by chance
    common: int  # the language most labelled documents have


def fit(docs: DataFrame, held_out: Column, per_language: int = 2000, slots: int = 1 << 20, least: int = 2, ratio: float = 0.1) -> LanguageFilter:
    """Fill the filter from labelled documents that are not held out.

    About ``per_language`` documents of each language are read, chosen by hash, all if there
    are fewer. A language contains an n-gram that occurs ``least`` times in them and at
    ``ratio`` of the highest rate of any language, or more. The filter has ``slots`` slots, a
    power of two, whatever the corpus. Rows without text or lang are not learned from.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return LanguageFilter([], np.zeros((1, slots), np.int64), np.zeros(0), 0)
    of = F.create_map(*[F.lit(x) for lang in langs for x in (lang, counts[lang])])[F.col("lang")]
    sample = known.where(hash_share(per_language, of, "doc_id", "text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        is_letter = letters()
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                for found, _ in grams_of(part["text"].tolist(), is_letter):
                    gram, n = np.unique(found, return_counts=True)
                    yield pd.DataFrame({"gram": gram.view(np.int64), "lang": lang, "n": n})

    rates = (
        sample.mapInPandas(count, "gram long, lang string, n long")
        .groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    )
    totals = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.sum(F.length("text") + 1).alias("n")).collect()}
    total = F.create_map(*[F.lit(x) for lang in langs for x in (lang, float(max(1, totals.get(lang) or 1)))])[F.col("lang")]
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])[F.col("lang")]
    rates = rates.select("gram", "n", number.alias("i"), (F.col("n") / total).alias("rate"))
    rates = rates.withColumn("top", F.max("rate").over(W.partitionBy("gram"))).where((F.col("n") >= least) & (F.col("rate") >= ratio * F.col("top")))
    shift = slots.bit_length() - 1
    probes = F.array(*[F.shiftrightunsigned("gram", j * 21).bitwiseAND(F.lit(slots - 1)) for j in range(PROBES)])
    bit = F.expr(f"shiftleft(1L, CAST(i % {BITS} AS INT))")
    rows = (
        rates.select(F.explode(probes).alias("slot"), F.floor(F.col("i") / BITS).alias("word"), bit.alias("bit"))
        .groupBy("slot", "word").agg(F.bit_or("bit").alias("mask")).toPandas()  # at most one row per slot and word
    )
    assert shift <= 21, "at most 2^21 slots"
    masks = np.zeros((-(-len(langs) // BITS), slots), np.int64)
    masks[rows["word"].to_numpy(int), rows["slot"].to_numpy(int)] = rows["mask"].to_numpy(np.int64)
    fill = np.array([((masks[i // BITS] >> (i % BITS)) & 1).mean() for i in range(len(langs))])
    return LanguageFilter(langs, masks, np.minimum(fill**PROBES, 0.99), int(np.argmax([counts[x] for x in langs])))


def hits(model: LanguageFilter, grams: np.ndarray, owner: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out``, per text and language, the n-grams that the language contains; the last column counts n-grams."""
    slots, n = model.masks.shape[1], len(out)
    out[:, -1] += np.bincount(owner, minlength=n)
    places = [(grams >> np.uint64(j * 21)) & np.uint64(slots - 1) for j in range(PROBES)]
    for w in range(len(model.masks)):
        mask = model.masks[w][places[0]]
        for p in places[1:]:
            mask &= model.masks[w][p]
        some = mask != 0
        mask, of = mask[some], owner[some]
        for i in range(w * BITS, min(len(model.langs), (w + 1) * BITS)):
            out[:, i] += np.bincount(of, weights=(mask >> (i % BITS)) & 1, minlength=n)


def unexplained(model: LanguageFilter, counts: np.ndarray) -> np.ndarray:
    """The hits that chance does not explain."""
    return np.maximum(0, (counts[:, :-1] - counts[:, -1:] * model.chance) / (1 - model.chance))


def predict(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, whole texts, nothing else read.

    ``und`` with score 0 for null texts and texts without a letter, or if nothing was
    learned. Else a learned language; the score is the corrected share of the text's n-grams
    that it contains. Ties go to the first language by name, texts without hits to the most
    frequent language, with score 0. Existing columns of the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def tell(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m, is_letter = shared.value, letters()
        for series in batches:
            texts, names, scores = series.tolist(), [], []
            counts = np.zeros((len(texts), len(m.langs) + 1))
            for grams, owner in grams_of(texts, is_letter) if m.langs else ():
                hits(m, grams, owner, counts)
            table = unexplained(m, counts)
            for t, row, n in zip(texts, table, counts[:, -1]):
                if not m.langs or not t or not (n or any(map(str.isalpha, t))):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(np.argmax(row))
                share = row[best] / n if n else 0.0
                names.append(m.langs[best if share > 0 else m.common])
                scores.append(float(min(1.0, share)))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    told, = fresh(docs, "told")
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.withColumn(told, tell(F.col(text))).select(*[F.col(f"`{c}`") for c in kept], F.col(told)["lang_pred"].alias("lang_pred"), F.col(told)["score"].alias("score"))


def keep_known(docs: DataFrame, least_score: float = 0.02, **options) -> DataFrame:
    """Stage: learn from the labelled rows, keep the rows whose text is in a learned language.

    Rejected are null texts, texts without letters and texts of which less than
    ``least_score`` of the n-grams belong to the best language. Without any label nothing can
    be judged, and only texts without a letter go. Columns stay as they are.
    """
    columns = docs.columns
    model = fit(docs, fold("doc_id", 3) == 1, **options)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # The row travels once: its own text is read inside it.
    told = predict(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")), model, "row.text")
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select(*[F.col("row")[c].alias(c) for c in columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 3) == 1
    model = fit(docs, held_out)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
