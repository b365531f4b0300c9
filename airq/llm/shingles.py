"""Word shingles as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

from airq.llm.common import WordHashes, mix


def words(text: str | None) -> list[bytes]:
    """The words between spaces and the control characters 9 to 13, with A-Z lowered."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_sets(texts: list, size: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text in ascending order, one text after the other, and their numbers.

    Texts of fewer than ``size`` words have one shingle of all their words; texts without words have none.
    """
    split = [words(t) for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    if not counts.sum():
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    word = np.concatenate([known.of(w) for w in split if w])
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    short = counts < size
    # Position in the text, and how many words each shingle takes.
    place = np.arange(len(word)) - (ends - counts)[owner]
    take = np.minimum(counts, size)[owner]
    starts = np.where(short[owner], place == 0, place <= counts[owner] - size)
    at, take = np.flatnonzero(starts), take[starts]
    value = take.astype(np.uint64)
    for j in range(size):
        follows = take > j
        value = np.where(follows, mix(value * np.uint64(0x9E3779B97F4A7C15) + word[np.minimum(at + j, len(word) - 1)]), value)
    owner = owner[at]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[first], np.bincount(owner[first], minlength=len(texts))
