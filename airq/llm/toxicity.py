"""Toxicity by a weighted lexicon, found by Aho-Corasick in folded text.

Folding undoes disguises: case, accents, fullwidth forms, letters of other
scripts that look alike, digits and signs written for letters. Words and word
beginnings that labelled toxic documents use far more often than clean ones
form the lexicon; its weights are their log ratios. A hit inside an exception
phrase does not count. The summed weight and its share of the text's length
are turned into a score by a small logistic fit.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.llm.common import fold, fresh, hash_share

#: Letters of other scripts by the Latin letter they are taken for.
LOOKALIKES = {
    "a": "аαɑ", "b": "вβ", "c": "сϲ", "d": "ԁ", "e": "еєε", "g": "ɡ", "h": "һн", "i": "іιıɩ", "j": "ј", "k": "кκ", "m": "м", "n": "пη",
    "o": "оοσ", "p": "рρ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υ", "v": "ѵν", "w": "ѡω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
#: Digits by the letter they are written for. One stands for i and l, so these two fold together.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "l": "i"}
#: Signs by the letter they are written for when a letter or digit follows.
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}
#: Harmless phrases around lexicon words, besides those that the labels show.
PHRASES = ("trash can", "trash bin", "trash collection", "class clown", "clown fish", "circus clown")
STEMS = (4, 5, 6)


def folding() -> dict[int, str]:
    """Code point to folded letter: decompositions by rule, then the tables above."""
    table = {}
    for i in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = unicodedata.normalize("NFKD", chr(i)).lower()[:1]
        if plain.isascii() and plain.isalnum():
            table[i] = DIGITS.get(plain, plain)
    for plain, alike in LOOKALIKES.items():
        table |= {ord(c): DIGITS.get(plain, plain) for c in alike}
    return table | {ord(c): letter for c, letter in DIGITS.items()}


class Folder:
    """Folds text into words of folded letters, one space between."""

    def __init__(self):
        self.table = folding()
        self.signs = re.compile("[" + re.escape("".join(SIGNS)) + r"](?=[^\W_])")
        self.words = re.compile(r"[^\W_]+")

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        text = self.signs.sub(lambda m: SIGNS[m[0]], text.lower())
        return self.words.findall(text.translate(self.table))


@dataclass(frozen=True)
class Lexicon:
    """Terms (``word`` whole, ``word*`` beginnings) with weights, exception phrases, and the fitted curve."""

    weights: dict[str, float]
    phrases: tuple[str, ...]
    curve: tuple[float, float, float]


class Scorer:
    """The lexicon as an automaton over ' word word ... '."""

    def __init__(self, lexicon: Lexicon):
        self.folder, self.lexicon = Folder(), lexicon
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.weights.items():
            pattern = f" {term[:-1]}" if term.endswith("*") else f" {term} "
            self.automaton.add_word(pattern, (len(pattern), weight))
        for phrase in lexicon.phrases:
            pattern = f" {phrase} "
            self.automaton.add_word(pattern, (len(pattern), 0.0))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def features(self, text: str | None) -> tuple[float, int]:
        """Summed weight of the hits outside exceptions, one per word, and the number of words."""
        words = self.folder(text)
        if self.empty or not words:
            return 0.0, len(words)
        hits: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(f" {' '.join(words)} "):
            start = end - size + 1
            if weight:
                hits[start] = max(weight, hits.get(start, 0.0))
            else:
                spared.append((start, end))
        for a, b in spared:
            for start in [s for s in hits if a <= s < b]:
                del hits[start]
        return sum(hits.values()), len(words)

    def score(self, weight: float, words: int) -> float:
        if weight <= 0:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.lexicon.curve, shape(weight, words)), -30, 30))))


def shape(weight, words):
    """What the curve sees: nothing, the sum, and the sum per hundred words, in logs."""
    return np.array([np.ones_like(weight * 1.0), np.log1p(weight), np.log1p(100.0 * weight / np.maximum(words, 1))])


def fit_curve(weight: np.ndarray, words: np.ndarray, toxic: np.ndarray, steps: int = 50, ridge: float = 0.05) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, held near a plain prior, over hits only."""
    prior = np.array([-4.0, 1.5, 0.5])
    some = weight > 0
    x, y, beta = shape(weight[some], words[some]).T, toxic[some].astype(float), prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * len(y) ** 0.5 * (beta - prior) - 0.1 * (beta - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + (ridge * len(y) ** 0.5 + 0.1) * np.eye(3)
        beta = beta + np.linalg.solve(bend, slope)
    return tuple(beta.tolist())


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, per_class: int = 4000, most_terms: int = 2000, least_docs: int = 3, least_ratio: float = 1.0, doubt: float = 1.64) -> Lexicon:
    """Learn from about ``per_class`` toxic and as many clean documents, chosen by hash of the id.

    ``held_out`` is a condition on ``doc_id``. A document with several labels is toxic if one
    says so. At most ``most_terms`` terms stay: words and beginnings of 4 to 6 letters that
    ``least_docs`` toxic documents hold, and that toxic documents hold exp(``least_ratio``)
    times as often as clean ones. The log ratio is lowered by ``doubt`` standard errors, so
    that rare terms weigh little. A phrase of two words around a term is an exception if clean
    documents hold it ``least_docs`` times and toxic ones never. Without labels the lexicon is empty.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return Lexicon({}, (), (-4.0, 1.5, 0.5))
    of = F.when(F.col("toxic") == 1, counts[1]).otherwise(counts[0])
    chosen = F.broadcast(known.where(hash_share(per_class, of, "doc_id")))  # about 2 * per_class rows of two numbers
    sample = docs.where(~held_out).select("doc_id", "text").join(chosen, "doc_id").where(F.col("text").isNotNull())

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        folder = Folder()
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = set(folder(text))
                seen[int(toxic)].update(words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) >= k})
            for toxic, found in seen.items():
                yield pd.DataFrame({"term": list(found), "toxic": toxic, "n": list(found.values())})

    n1, n0 = (min(counts[k], per_class) for k in (1, 0))
    ratio = F.log(F.col("n1") / n1) - F.log((F.col("n0") + 1) / (n0 + 1)) - doubt * F.sqrt(1 / F.col("n1") + 1 / (F.col("n0") + 1))
    top = (
        sample.mapInPandas(terms, "term string, toxic int, n long")
        .groupBy("term").agg(F.sum(F.col("n") * F.col("toxic")).alias("n1"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("n0"))
        .where(F.col("n1") >= least_docs).withColumn("ratio", ratio).where(F.col("ratio") >= least_ratio)
        .orderBy(F.desc(F.col("ratio") * F.sqrt("n1")), "term").limit(most_terms).collect()
    )
    weights = {r["term"]: float(r["ratio"]) for r in top}
    stems = sorted((t[:-1] for t in weights if t.endswith("*")), key=len)
    short = {s for i, s in enumerate(stems) if not any(s[:k] + "*" in weights for k in STEMS if k < len(s))}
    weights = {t: w for t, w in weights.items() if (t[:-1] in short if t.endswith("*") else not any(t[:k] in short for k in STEMS))}
    pairs = sample.sparkSession.sparkContext.broadcast(weights)

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        folder, terms = Folder(), pairs.value
        term = lambda w: w in terms or any(w[:k] + "*" in terms for k in STEMS)
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = folder(text)
                seen[int(toxic)].update({f"{a} {b}" for a, b in zip(words, words[1:]) if term(a) or term(b)})
            for toxic, found in seen.items():
                yield pd.DataFrame({"phrase": list(found), "toxic": toxic, "n": list(found.values())})

    clean = (
        sample.mapInPandas(around, "phrase string, toxic int, n long")
        .groupBy("phrase").agg(F.sum(F.col("n") * F.col("toxic")).alias("n1"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("n0"))
        .where((F.col("n1") == 0) & (F.col("n0") >= least_docs)).orderBy(F.desc("n0"), "phrase").limit(most_terms).collect()
    )
    folder = Folder()
    phrases = tuple(dict.fromkeys([*(" ".join(folder(p)) for p in PHRASES), *(r["phrase"] for r in clean)]))
    draft = Lexicon(weights, phrases, (0.0, 0.0, 0.0))
    held = sample.sparkSession.sparkContext.broadcast(draft)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(held.value)
        for batch in batches:
            rows = [scorer.features(t) for t in batch["text"]]
            yield pd.DataFrame({"weight": [float(r[0]) for r in rows], "words": [r[1] for r in rows], "toxic": batch["toxic"]})

    seen = sample.mapInPandas(measure, "weight double, words long, toxic int").toPandas()  # about 2 * per_class rows
    curve = fit_curve(seen["weight"].to_numpy(float), seen["words"].to_numpy(float), seen["toxic"].to_numpy())
    return Lexicon(weights, phrases, curve)


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with ``score``: 0 for null or empty texts and texts without a hit, else the curve's value."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def tell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(held.value)
        for series in batches:
            yield pd.Series([scorer.score(*scorer.features(t)) for t in series], dtype=float)

    told, = fresh(docs, "told")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "score"]
    return docs.withColumn(told, tell(F.col(text))).select(*kept, F.col(told).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = fold("doc_id", 4) == 2
    told = score(docs, fit(docs, labels, held_out))
    return told.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
