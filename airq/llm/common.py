"""Helpers the operators share: row identity, fresh names, hashed words."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters handled at once inside a task; bounds a worker's memory.
CHUNK_CHARS = 2_000_000
#: Distinct words whose hashes a worker remembers before it starts anew.
CACHE_WORDS = 500_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word, computed once per word and task."""

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def chunks(texts: list, most: int = CHUNK_CHARS):
    """Runs (from, to) of ``texts`` of about ``most`` characters; a longer text is a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, whatever their case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def hash_share(bound: int, count: Column, *cols: str) -> Column:
    """True for about ``bound`` of ``count`` rows, chosen by the hash of ``cols``; for all if they are fewer."""
    return F.pmod(F.xxhash64(*cols), F.lit(1_000_000_007)) <= F.floor(F.lit(float(bound * 1_000_000_007)) / count)


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
