"""Byte-level BPE: speculate by greedy longest match, verify, merge exactly where that fails.

A sequence of tokens is what the merges give if each of its adjacent pairs is:
if the merges of both tokens' bytes, run together, end in these two tokens. So
a greedy split is checked pair by pair. All pairs of many words are checked at
once in arrays, along the tokens' inner edges, and only the words with a wrong
pair run the merges.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.llm.common import CACHE_WORDS, chunks

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: how byte-level BPE of this kind splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NEVER = np.int64(1 << 40)
#: Words of up to so many bytes are merged in steps of many words.
SHORT = 48
#: Characters of all remembered words, and of texts handled at once; bound a worker's memory.
CACHE_CHARS, CHUNK_CHARS = 8_000_000, 500_000
#: Ids joined, hashed or decoded at once.
STRETCH = 100_000


def byte_letters() -> dict[str, int]:
    """The byte that each letter of the vocabulary file stands for: printable ones themselves, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Known(dict):
    """Numbers of the words seen so far, with their ids one after the other in one array."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.chars = 0
        self.flat, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        self.chars += len(word)
        return number

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def numbers_of(self, split: regex.Pattern, text: str) -> np.ndarray:
        """The same for the words of a text; those of a long text never stand in a list."""
        if len(text) <= CHUNK_CHARS:
            return self.numbers(split.findall(text))
        return np.fromiter((self[m.group()] for m in split.finditer(text)), np.int64)

    def learn(self, bpe: Bpe) -> None:
        """Encode the words that came up since the last call."""
        ids, _ = bpe.encode_words(self.new)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(sizes)))
        self.new = []

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        special = numbers < 0
        at = np.where(special, 0, numbers) if special.any() else numbers
        if not len(at):
            return np.empty(0, np.int32)
        starts = self.starts[at]
        sizes = self.starts[at + 1] - starts if len(self.starts) > 1 else np.zeros(len(at), np.int64)
        sizes = np.where(special, 1, sizes)
        ends = np.cumsum(sizes)
        out = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
        if not special.any():
            return self.flat[out]
        out = self.flat[np.minimum(out, len(self.flat) - 1)] if len(self.flat) else np.zeros(len(out), np.int32)
        out[(ends - 1)[special]] = ~numbers[special]
        return out


class Bpe:
    """A vocabulary with its merges, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.ids = {as_bytes(s): i for s, i in vocab.items()}
        size = max(vocab.values()) + 1
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([size, *(i + 1 for i in self.special.values())])
        self.bytes = [b""] * size
        for b, i in self.ids.items():
            self.bytes[i] = b
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.made = np.full(size, -1, np.int64)  # the rank of the merge that makes a token
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        unsure = set()
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if self.made[z] >= 0:
                unsure.add(z)  # made by two merges: never trusted
            self.merges[x, y] = (rank, z)
            self.left[z], self.right[z], self.made[z] = x, y, rank
        keys = np.array([(x << 32) | y for x, y in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.result = np.array([z for _, z in self.merges.values()], np.int64)
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.longest: dict[bytes, int] = {}  # by the first four bytes
        for b in self.ids:
            if len(b) >= 4:
                self.longest[b[:4]] = max(len(b), self.longest.get(b[:4], 4))
        self.trusted = np.ones(size, bool)
        for b, i in self.ids.items():
            self.trusted[i] = i not in unsure and (len(b) == 1 or self.made[i] >= 0)
        self.split = regex.compile(SPLIT)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def greedy(self, word: bytes) -> list[int]:
        """The longest token at each place."""
        ids, longest, out, at, n = self.ids, self.longest, [], 0, len(word)
        while at < n:
            end = min(n, at + longest.get(word[at : at + 4], 3))
            while (token := ids.get(word[at:end])) is None:
                end -= 1
            out.append(token)
            at = end
        return out

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether the merges of their joint bytes leave just these two.

        Goes back in time through the tokens that meet at the border. Two that stand there
        together would merge if their merge comes before those that consume them (the left one
        first among equal merges).
        """
        good = self.trusted[x] & self.trusted[y]
        todo = np.flatnonzero(good)
        u, v = x[todo], y[todo]
        end_u, end_v = np.full(len(u), _NEVER), np.full(len(u), _NEVER)
        while len(todo):
            rank = self.rank_of(u, v)
            bad = (rank < end_u) & (rank <= end_v)
            good[todo[bad]] = False
            from_left = self.made[u] > self.made[v]
            go = ~bad & ((self.made[u] >= 0) | (self.made[v] >= 0))
            todo, u, v, end_u, end_v, from_left = (z[go] for z in (todo, u, v, end_u, end_v, from_left))
            end_u, end_v = np.where(from_left, self.made[u], end_u), np.where(from_left, end_v, self.made[v])
            u, v = np.where(from_left, self.right[u], u), np.where(from_left, v, self.left[v])
        return good

    def rank_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or ``_NEVER``."""
        key = (x << 32) | y
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.ranks[place], _NEVER)

    def merge_short(self, words: list[bytes]) -> list[list[int]]:
        """The merges themselves, lowest rank first, leftmost among equals, one step of all words at a time."""
        width = max(map(len, words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        token = self.single[np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)]
        rank = np.full((len(words), width), _NEVER)
        inside = np.arange(1, width)[None, :] < sizes[:, None]
        rank[:, :-1][inside] = self.rank_of(token[:, :-1][inside], token[:, 1:][inside])
        todo, done, columns = np.arange(len(words)), [None] * len(words), np.arange(width)[None, :]
        while len(todo):
            at = rank.argmin(1)
            rows = np.arange(len(todo))
            lowest = rank[rows, at]
            go = lowest < _NEVER
            for i, k, t in zip(todo[~go].tolist(), sizes[~go].tolist(), token[~go].tolist()):
                done[i] = t[:k]
            todo, at, lowest, token, rank, sizes = todo[go], at[go], lowest[go], token[go], rank[go], sizes[go] - 1
            rows, behind = np.arange(len(todo)), columns > at[:, None]
            token[:, :-1] = np.where(behind[:, :-1], token[:, 1:], token[:, :-1])
            rank[:, :-1] = np.where(behind[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = _NEVER
            token[rows, at] = self.result[lowest]
            right = at + 1 < sizes
            rank[rows, at] = _NEVER
            rank[rows[right], at[right]] = self.rank_of(token[rows[right], at[right]], token[rows[right], at[right] + 1])
            left = at > 0
            rank[rows[left], at[left] - 1] = self.rank_of(token[rows[left], at[left] - 1], token[rows[left], at[left]])
        return done

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """Exact ids of words: short ones in steps of many words of like length, long ones by a heap."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        out: list[list[int]] = [[]] * len(words)
        short = [i for i in order if len(words[i]) <= SHORT]
        for a in range(0, len(short), 4096):
            part = short[a : a + 4096]
            for i, ids in zip(part, self.merge_short([words[i] for i in part])):
                out[i] = ids
        for i in order[len(short) :]:
            out[i] = self.merge_long(words[i])
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """The same with a heap, for words of any length."""
        token = [self.ids[word[i : i + 1]] for i in range(len(word))]
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        heap = [(m[0], i, token[i], token[i + 1]) for i in range(len(token) - 1) if (m := self.merges.get((token[i], token[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if token[i] == a else len(token)
            if j >= len(token) or token[j] != b:
                continue
            token[i], token[j] = self.merges[a, b][1], -1
            after[i] = after[j]
            if after[i] < len(token):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(token) and (m := self.merges.get((token[k], token[after[k]]))):
                    heapq.heappush(heap, (m[0], k, token[k], token[after[k]]))
        return [t for t in token if t >= 0]

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], int]:
        """Token ids of each word, and how many words had to be merged exactly."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out = [[i] if (i := self.ids.get(b)) is not None and self.trusted[i] else self.greedy(b) for b in raw]
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter(chain.from_iterable(out), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(out)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique((flat[inner] << 32) | flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        failing = sorted(set(owner[inner[~good[back]]].tolist()) | set(owner[~self.trusted[flat]].tolist()))
        for i, ids in zip(failing, self.merge_all([raw[i] for i in failing])):
            out[i] = ids
        return out, len(failing)

    def encode_texts(self, texts: list[str], known: Known) -> list[np.ndarray]:
        """Ids of each text; ``known`` keeps the words that were seen."""
        if len(known) > CACHE_WORDS or known.chars > CACHE_CHARS:
            known.forget()
        words: list[np.ndarray] = []  # numbers of words; ~id for a special id
        for text in texts:
            if self.special_split and any(s in text for s in self.special):
                parts = [[~self.special[p]] if p in self.special else known.numbers_of(self.split, p) for p in self.special_split.split(text)]
                words.append(np.concatenate([np.asarray(p, np.int64) for p in parts]))
            else:
                words.append(known.numbers_of(self.split, text))
        known.learn(self)
        return [known.ids(w) for w in words]

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        table = self.bytes
        return b"".join([table[i] for i in ids if 0 <= i < len(table)]).decode("utf-8", "replace")


def encode(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Token ids of whole texts as array<int>; null texts count as empty, empty texts have no ids."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe, known = Bpe(public_tokenizers.path(vocabulary)), Known()
        for series in batches:
            texts, out = [t or "" for t in series.tolist()], []
            for a, b in chunks(texts, CHUNK_CHARS):
                out += bpe.encode_texts(texts[a:b], known)
            yield pd.Series(out, dtype=object)

    return ids(text)


def decode(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The text of token ids; null for null."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = Bpe(public_tokenizers.path(vocabulary))
        for series in batches:
            yield pd.Series([None if x is None else bpe.decode(x.tolist()) for x in series], dtype=object)

    return texts(ids)


def digests(ids: np.ndarray, bpe: Bpe) -> tuple[str, str]:
    """SHA-256 of the decimal ids joined by commas, and of the decoded text in UTF-8, a stretch at a time."""
    joined, decoded = hashlib.sha256(), hashlib.sha256()
    table, decoder = bpe.bytes, codecs.getincrementaldecoder("utf-8")("replace")
    for a in range(0, len(ids), STRETCH):
        part = ids[a : a + STRETCH].tolist()
        joined.update(("," if a else "").encode() + ",".join(map(str, part)).encode())
        decoded.update(decoder.decode(b"".join([table[i] for i in part])).encode())
    decoded.update(decoder.decode(b"", True).encode())
    return joined.hexdigest(), decoded.hexdigest()


def coded_digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts, encoded and decoded again in one pass.

    Null texts count as empty; repeated rows stay; an empty table gives no rows. No ids leave the worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = Bpe(public_tokenizers.path(vocabulary)), Known()
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for a, b in chunks(texts, CHUNK_CHARS):
                ids = bpe.encode_texts(texts[a:b], known)
                told = [digests(i, bpe) for i in ids]
                columns = [pa.array([len(i) for i in ids], pa.int64()), *(pa.array([t[j] for t in told], pa.string()) for j in (0, 1))]
                yield pa.RecordBatch.from_arrays([batch["doc_id"][a:b], *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document; edge cases as ``coded_digests`` says."""
    return coded_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
