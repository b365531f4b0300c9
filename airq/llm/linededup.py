"""Repeated passages, found by winnowing over line hashes; matches are extended both ways from the fingerprints.

A text is wrapped into short lines: a line ends after a word whose hash is odd,
or else after three words, so a passage wraps alike wherever it stands, also
when it begins in the middle of a line or a break stands elsewhere in it. Every ``GRAM`` lines in a row have one hash, and of
every ``WINDOW`` such hashes in a row the smallest is a fingerprint. A passage of
``GRAM + WINDOW - 1`` whole lines that occurs twice therefore has a fingerprint
in common in both places. So a window of ``least_words`` words cannot stand elsewhere
if a fingerprint that all its copies must have is there only once.

Each of the other windows belongs to the first fingerprint that all its copies must have; the windows of one
place of a fingerprint, as far as they go left and right of it, are its run. The places of a fingerprint meet: those with
equal runs are alike in all their windows, so that all but the first are repeats. Only where a fingerprint
has unlike runs are the windows of the first place of each run compared, by hash, and the first place of each window is kept.
The places of a window are thus compared with each other whoever else holds a part of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.common import chunks, mix
from airq.sources.staging import release, stage

GRAM, WINDOW, LONGEST = 6, 10, 3
LEAST_WORDS = 50
#: A null id comes after all others.
LAST = (1 << 63) - 1


#: Characters of texts handled at once and bytes hashed at once; they bound a worker's memory.
CHUNK, SEGMENT = 250_000, 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
#: A number for each byte, none for white space; a byte's place multiplies it by a power of ``_STEP``.
_BYTE = np.where(_SPACE, np.uint64(0), mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP))
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


@lru_cache(1)
def powers(many: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``_STEP`` and of its inverse, modulo 2^64, from the first on."""
    return np.multiply.accumulate(np.full(many, _STEP)), np.multiply.accumulate(np.full(many, _BACK))


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words between spaces and the control characters 9 to 13: hashes, first bytes, ends."""
    found, at = [], 0
    while at < len(raw):
        end = len(raw)
        if end - at > SEGMENT:
            cut = max(raw.rfind(b" ", at, at + SEGMENT), raw.rfind(b"\n", at, at + SEGMENT))
            end = cut + 1 if cut >= at else min((i for i in (raw.find(b" ", at), raw.find(b"\n", at)) if i >= 0), default=end - 1) + 1
        buffer = np.frombuffer(raw, np.uint8, end - at, at)
        space = _SPACE[buffer]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        if len(starts):
            # A word's hash: the sum of its bytes' numbers by their places in the segment, moved back to the segment's beginning.
            power, back = powers(1 << max(SEGMENT, len(buffer) - 1).bit_length())
            value = _BYTE[buffer]
            value *= power[: len(buffer)]
            found.append((mix(np.add.reduceat(value, starts) * back[starts]), starts + at, ends + at))
        at = end
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def grams(hashes: np.ndarray, sizes: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Values of ``gram`` lines in a row, of texts whose word hashes stand one after the other: value, text, first word, last line's first word, end."""
    none, text_ends = np.empty(0, np.int64), np.cumsum(sizes)
    if not len(hashes):
        return np.empty(0, np.uint64), none, none, none, none
    last = (hashes & np.uint64(1)) == 1
    last[text_ends[sizes > 0] - 1] = True
    ends = np.flatnonzero(last) + 1
    starts = np.concatenate(([0], ends[:-1]))
    if (ends - starts).max() > LONGEST:
        pieces = -((starts - ends) // LONGEST)
        starts = np.repeat(starts, pieces) + LONGEST * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        ends = np.append(starts[1:], len(hashes))
    owner = np.searchsorted(text_ends, starts, "right")
    # A line's hash: the sum of its words' hashes, each mixed with its place in the line.
    place = np.arange(len(hashes)) - np.repeat(starts, ends - starts)
    line = mix(np.add.reduceat(mix(hashes + place.astype(np.uint64) * _STEP), starts))
    n = len(line) - gram + 1
    if n <= 0:
        return np.empty(0, np.uint64), none, none, none, none
    value = np.zeros(n, np.uint64)
    for j in range(gram):
        value = mix(value * _STEP + line[j : j + n])
    whole = owner[:n] == owner[gram - 1 :]
    return value[whole], owner[:n][whole], starts[:n][whole], starts[gram - 1 :][whole], ends[gram - 1 :][whole]


def winnowed(value: np.ndarray, of: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Each ``window`` values in a row of one text: the first one's number, and that of the rightmost smallest."""
    if len(value) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(value, window)
    at = np.flatnonzero(of[: len(windows)] == of[window - 1 :])
    return at, (window - 1 - np.argmin(windows[:, ::-1], 1))[at] + at


def fingerprints(hashes: np.ndarray, sizes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of texts whose word hashes stand one after the other: text, value, word at which each begins.

    A text of fewer than ``gram`` lines has none, one of fewer than ``window`` hashes has its smallest.
    """
    value, of, at, _, _ = grams(hashes, sizes, gram)
    if not len(value):
        return of, value, at
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    counts = np.diff(np.append(first, len(of)))
    # Neighbouring windows mostly share their smallest.
    picked = [winnowed(value, of, window)[1]]
    for i in np.flatnonzero(counts < window).tolist():
        picked.append([first[i] + int(np.argmin(value[first[i] : first[i] + counts[i]]))])
    picked = np.unique(np.concatenate(picked))
    return of[picked], value[picked], at[picked]


def prints_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Values and counts per text: its fingerprints in ascending order, twice if they have several places."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    hashes, starts, _ = hashed_words(b"\n".join(raw))
    text_ends = np.cumsum([len(r) + 1 for r in raw])
    sizes = np.bincount(np.searchsorted(text_ends, starts, "right"), minlength=len(raw))
    of, value, _ = fingerprints(hashes, sizes)
    value = value.view(np.int64)
    order = np.lexsort((value, of))
    of, value = of[order], value[order]
    third = np.zeros(len(value), bool)
    third[2:] = (of[2:] == of[:-2]) & (value[2:] == value[:-2])
    return value[~third], np.bincount(of[~third], minlength=len(raw))


def occurrences(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash and fingerprints, twice if they have several places, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in chunks(texts, CHUNK):
                values, counts = prints_of(texts[a:b])
                sizes = np.concatenate(([0], np.cumsum(counts)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][a:b], batch["text_hash"][a:b], pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int64()))],
                    ["doc_id", "text_hash", "prints"],
                )

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return stage(keyed.mapInArrow(run, "doc_id long, text_hash long, prints array<long>").where(F.size("prints") > 0), "prints")


def spanned(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each ``n`` hashes in a row, put together from those of 1, 2, 4 and so on."""
    many = len(hashes) - n + 1
    value, done, part, size = np.zeros(many, np.uint64), 0, mix(hashes + _STEP), 1
    while True:
        if n & size:
            value = mix(value * _STEP + part[done : done + many])
            done += size
        if done == n:
            return value
        part, size = mix(part[:-size] * _STEP + part[size:]), 2 * size


def windows_of(texts: list, again: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Windows of ``least`` words that may stand elsewhere, in order, and which of them begin a run.

    Of each window: text, number of the first word, hash, first code point, end; of each run: number of its first
    window, fingerprint. ``again`` has the repeated fingerprints. A line that begins after an odd word of the
    window begins there in every copy, and so do the lines after it; the fingerprint of such lines that end in
    the window is in every copy too. If it is not repeated, nor is the window. A window without such lines
    is a run of its own, with its hash in place of the fingerprint.
    """
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    joined = b"\n".join(raw)
    hashes, starts, ends = hashed_words(joined)
    byte_ends = np.cumsum([len(r) + 1 for r in raw])
    owner = np.searchsorted(byte_ends, starts, "right")
    sizes = np.bincount(owner, minlength=len(raw))
    many, none = len(hashes) - least + 1, np.empty(0, np.int64)
    if many <= 0:
        return none, none, none, none, none, none, none
    value, of, at, line, end = grams(hashes, sizes)
    first, chosen = winnowed(value, of)
    begin, line, end = at[first], line[first + WINDOW - 1], end[first + WINDOW - 1]
    # A line that only its text's end cuts short may go on in a copy.
    whole = ((hashes[end - 1] & np.uint64(1)) == 1) | (end - line == LONGEST)
    odd = np.flatnonzero(hashes & np.uint64(1))
    before = np.searchsorted(odd, begin)  # odd words before the lines
    whole &= before > 0
    end, before, value = end[whole], before[whole], value[chosen[whole]]
    low, high = np.maximum(end - least, 0), odd[before - 1] + 1
    fits = low < high
    low, high, value, place = low[fits], high[fits], value[fits].view(np.int64), chosen[whole][fits]
    once = ~np.isin(value, again)
    alone = np.cumsum(np.bincount(low[once], minlength=len(hashes) + 1) - np.bincount(high[once], minlength=len(hashes) + 1))[:many] > 0
    kept = np.flatnonzero((owner[:many] == owner[least - 1 :]) & ~alone)
    if not len(kept):
        return none, none, none, none, none, none, none
    key = spanned(hashes, least)[kept].view(np.int64)
    # Lines further on come later and end later, so the first that begin late enough are the first that fit.
    mine, print_ = -1 - kept, key.copy()
    if len(high):
        nth = np.minimum(np.searchsorted(high, kept, "right"), len(high) - 1)
        has = (low[nth] <= kept) & (kept < high[nth])
        mine[has], print_[has] = place[nth[has]], value[nth[has]]
    runs = np.flatnonzero(np.concatenate(([True], (mine[1:] != mine[:-1]) | (np.diff(kept) != 1))))
    of = owner[kept]
    lead = (np.frombuffer(joined, np.uint8) & 0xC0) != 0x80
    points = np.concatenate(([0], np.cumsum(lead)))
    text_start = points[byte_ends - [len(r) + 1 for r in raw]]
    word_start = np.cumsum(sizes) - sizes
    return of, kept - word_start[of], key, points[starts[kept]] - text_start[of], points[ends[kept + least - 1]] - text_start[of], runs, print_[runs]


def lists(values: np.ndarray, of: np.ndarray, many: int, kind: pa.DataType) -> pa.Array:
    """One list per text of the values, which stand in the order of their texts ``of``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(of, minlength=many)))), pa.int32()), pa.array(values, kind))


def ints(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    """A list of a row as an array, empty if it is null."""
    value = batch[name][i]
    return value.values.to_numpy(zero_copy_only=False) if value.is_valid else np.empty(0, np.int64)


def removals(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, text_hash, spans, words): the spans of code points that repeat an earlier passage, per document.

    Earlier is a smaller doc_id, then a smaller text hash, then an earlier place; null ids come last (as
    the largest number). Rows with the same id and text are one document. Spans run from the first to the
    end of the last word, do not overlap and are in order.
    """
    prints = occurrences(docs)
    # A row by one hash: rows that share it would only see each other's repeated fingerprints.
    row = F.xxhash64("doc_id", "text_hash").alias("row")
    each = prints.select(row, F.explode("prints").alias("print"))
    again = stage(each.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print"), "again")
    # Each fingerprint is there once, so its table is hashed and the long side is not sorted.
    matched = each.join(again.hint("shuffle_hash"), "print").groupBy("row").agg(F.collect_set("print").alias("prints"))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, prints = batch["text"].to_pylist(), batch["prints"]
            for a, b in chunks(texts, CHUNK):
                of, at, key, start, end, runs, print_ = windows_of(texts[a:b], np.unique(prints[a:b].flatten().to_numpy(zero_copy_only=False)), least_words)
                many, sizes = b - a, np.diff(np.append(runs, len(of)))
                whole = mix(np.add.reduceat(mix(key.view(np.uint64)), runs) + sizes.astype(np.uint64)).view(np.int64) if len(runs) else runs
                step = np.diff(start, prepend=0)
                new = np.flatnonzero(np.diff(of, prepend=-1))
                step[new] = start[new]
                columns = [lists(c, of[runs], many, k) for c, k in ((print_, pa.int64()), (whole, pa.int64()), (at[runs], pa.int32()), (sizes, pa.int32()))]
                columns += [lists(c, of, many, k) for c, k in ((key, pa.int64()), (step, pa.int32()), (end - start, pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch["doc_id"][a:b], batch["text_hash"][a:b], *columns], ["doc_id", "text_hash", "print", "run", "at", "n", "key", "step", "width"])

    looked = texts.withColumn("row", row).join(matched, "row").select("doc_id", "text_hash", "prints", "text")
    shape = "doc_id long, text_hash long, print array<long>, run array<long>, at array<int>, n array<int>, key array<long>, step array<int>, width array<int>"
    windows = stage(looked.mapInArrow(look, shape).where(F.size("at") > 0), "windows")
    release(prints, again)
    # The places of a fingerprint with equal runs: the least merges before the shuffle, and only its document hears of it.
    places = windows.select("doc_id", "text_hash", F.explode(F.arrays_zip("print", "run", "at")).alias("r"))
    places = places.select("r.print", "r.run", F.struct("doc_id", "text_hash", "r.at").alias("place"))
    alike = stage(places.groupBy("print", "run").agg(F.min("place").alias("f")).select("print", "f.*"), "alike")
    unlike = alike.groupBy("print").agg(F.count("*").alias("runs")).where("runs > 1").select("print", F.lit(True).alias("open"))
    firsts = alike.join(unlike.hint("shuffle_hash"), "print", "left").groupBy("doc_id", "text_hash")
    firsts = firsts.agg(F.collect_list("at").alias("firsts"), F.collect_list(F.when(F.col("open"), F.col("at"))).alias("open"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Later runs as pieces: first and last window's word, first code point, end; of unlike runs all windows."""
        for batch in batches:
            pieces, windows = [], []
            for i in range(batch.num_rows):
                at, n, step, width, key, known, open_ = (ints(batch, c, i) for c in ("at", "n", "step", "width", "key", "firsts", "open"))
                at, start = at.astype(np.int64), np.cumsum(step, dtype=np.int64)
                end, first = start + width, np.cumsum(n) - n
                later, last = ~np.isin(at, known), first + n - 1
                pieces.append(np.array([at, at + n - 1, start[first], end[last]])[:, later])
                chosen = np.flatnonzero(np.repeat(np.isin(at, open_), n))
                word = np.repeat(at - first, n)[chosen] + chosen
                windows.append(np.array([word, key[chosen], start[chosen], end[chosen]], np.int64))
            of = [np.repeat(np.arange(batch.num_rows), [x.shape[1] for x in xs]) for xs in (pieces, windows)]
            columns = [lists(c, o, batch.num_rows, pa.int64()) for xs, o in zip((pieces, windows), of) for c in (np.concatenate(xs, 1) if xs else np.empty((4, 0), np.int64))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], *columns], ["doc_id", "text_hash", *judged_names])

    judged_names = ["from", "to", "from_at", "to_at", "at", "key", "start", "end"]
    judged = windows.drop("print", "run").join(firsts, ["doc_id", "text_hash"], "left")
    judged = judged.mapInArrow(judge, "doc_id long, text_hash long, " + ", ".join(f"`{c}` array<long>" for c in judged_names))
    judged = stage(judged.where((F.size("from") > 0) | (F.size("at") > 0)), "judged")
    release(windows, alike)
    places = judged.select("doc_id", "text_hash", F.explode(F.arrays_zip("key", "at")).alias("w")).select("w.key", F.struct("doc_id", "text_hash", "w.at").alias("place"))
    firsts = places.groupBy("key").agg(F.min("place").alias("f")).groupBy("f.doc_id", "f.text_hash").agg(F.collect_list("f.at").alias("firsts"))
    known = judged.drop("key").join(firsts, ["doc_id", "text_hash"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                first, last, start, end, at, begin, finish, firsts = (ints(batch, c, i) for c in ("from", "to", "from_at", "to_at", "at", "start", "end", "firsts"))
                later = ~np.isin(at, firsts)
                pieces = np.concatenate((np.array([first, last, start, end], np.int64), np.array([at, at, begin, finish], np.int64)[:, later]), 1)
                if not pieces.shape[1]:
                    continue
                first, last, start, end = pieces[:, np.argsort(pieces[0], kind="stable")]
                cut = np.flatnonzero(first[1:] - last[:-1] > least_words)
                heads, tails = np.concatenate(([0], cut + 1)), np.append(cut, len(first) - 1)
                spans = [{"start": x, "end": y} for x, y in zip(start[heads].tolist(), end[tails].tolist())]
                out.append((batch["doc_id"][i].as_py(), batch["text_hash"][i].as_py(), spans, int((last[tails] + least_words - first[heads]).sum())))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)], ["doc_id", "text_hash", "spans", "words"])

    spans = known.mapInArrow(run, "doc_id long, text_hash long, spans array<struct<start:long,end:long>>, words long")
    return spans.dropDuplicates(["doc_id", "text_hash"])


def keep_new(docs: DataFrame, **options) -> DataFrame:
    """Stage: the repeated passages are cut out of the texts; ``n_chars`` follows if it is there.

    A document from which something was cut goes if no word is left. All others stay as they are, null
    and empty texts too, and columns stay.
    """
    columns = docs.columns
    cut = stage(removals(docs, **options), "removals").select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "spans")
    row, key, hash_ = "row_", "key_", "hash_"
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias(row), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias(key), F.xxhash64("text").alias(hash_), "text")
    joined = marked.join(cut, (F.col(key) == F.col("c_id")) & (F.col(hash_) == F.col("c_hash")), "left")
    left = F.expr("""aggregate(spans, named_struct('at', 0L, 'out', ''), (acc, x) ->
      named_struct('at', x.end, 'out', concat(acc.out, substring(text, CAST(acc.at AS INT) + 1, CAST(x.start - acc.at AS INT)))),
      acc -> concat(acc.out, substring(text, CAST(acc.at AS INT) + 1)))""")
    told = joined.select(row, "spans", F.when(F.col("spans").isNotNull(), left).otherwise(F.col("text")).alias("left"))
    told = told.where(F.col("spans").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    kind = dict(docs.dtypes).get("n_chars", "long")
    new = {"text": F.col("left")}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.col("spans").isNotNull(), F.char_length("left").cast(kind)).otherwise(F.col(row)["n_chars"])
    return told.select(*[(new[c] if c in new else F.col(row)[c]).alias(c) for c in columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Per document: the words cut and the spans (start:end, code points, joined by commas)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = removals(docs).select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "words", "spans")
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("key"), F.xxhash64("text").alias("hash"))
    told = keyed.join(cut, (F.col("key") == F.col("c_id")) & (F.col("hash") == F.col("c_hash")), "left")
    spans = F.expr("array_join(transform(spans, s -> concat(s.start, ':', s.end)), ',')")
    return told.select("doc_id", F.coalesce("words", F.lit(0)).alias("n_words_cut"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), F.coalesce(spans, F.lit("")).alias("spans"))
