"""Long repeated byte strings, removed exactly by suffix order.

Whether the string of ``length`` bytes at a start occurs elsewhere is seen from
the sorted suffixes of all texts: two neighbours there share that many bytes.
The corpus is brought into blocks that can be sorted on their own. Of all runs of ``gram``
bytes within a string, the one of least hash is its anchor, so
equal strings have equal anchors at the same place. Neighbouring starts with one anchor
are a piece of the text, a few hundred bytes long, and only pieces with
equal anchors can have strings in common. Pieces whose anchor is nowhere else are done, equal pieces
are counted, and the different pieces of an anchor go on: they are cut again by longer
anchors, which settles most of them alike, and what is left goes to a block together.

A block's pieces are sorted column by column, from their last symbols to their
first: each round puts one more symbol before every piece's suffix and inserts the new
suffixes into the Burrows-Wheeler transform of the block, with the lengths of
their common prefixes. The transform is kept as the rows that its symbols
come from, which lie in ascending order for each symbol, so that places are found by search.
Symbols are bytes, but an anchor, which all strings of its piece contain, is one symbol, so there are few rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.common import mix
from airq.sources.staging import release, stage

LENGTH, GRAMS = 400, (192, 384)
#: Bytes hashed at once inside a task; longer texts are cut, and pieces end there.
PART_BYTES = 1 << 18
#: Symbols of pieces sorted together, but for one anchor's; anchors with more different pieces are compared string by string.
BLOCK_SYMBOLS, BLOCK_PIECES = 100_000, 4000

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
PIECE = ["start", "size", "place", "key", "d1", "d2"]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Finds pieces; keeps the powers its rolling hash needs."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.up = self.down = np.empty(0, np.uint64)
        self.letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

    def hashes(self, raw: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each ``gram`` bytes in a row."""
        if len(self.up) < len(raw):
            self.up, self.down = _powers(_BASE, len(raw)), _powers(_BACK, len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.letters[raw] * self.up[: len(raw)], out=sums[1:])
        return mix((sums[self.gram :] - sums[: -self.gram]) * self.down[: len(raw) - self.gram + 1])

    def pieces(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces of texts that stand one after the other: text, start in ``raw``, number of starts, the anchor's distance from it and hash.

        The anchor of a start is the leftmost least hash among the runs within its string. ``raw`` has at
        most 2^22 bytes.
        """
        none = np.empty(0, np.int64)
        if len(raw) < self.length:
            return none, none, none, none, np.empty(0, np.uint64)
        hashes = self.hashes(raw)
        # The upper bits of the hash, then the place: the least is the leftmost of equal ones.
        least, width, window = (hashes >> np.uint64(22) << np.uint64(22)) | np.arange(len(hashes), dtype=np.uint64), 1, self.length - self.gram + 1
        while 2 * width <= window:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < window:
            least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
        anchor = (least & np.uint64((1 << 22) - 1)).astype(np.int64)
        starts = np.concatenate(([0], ends[:-1]))
        inside = np.zeros(len(anchor) + 1, np.int8)
        long = ends - starts >= self.length
        inside[starts[long]] += 1
        inside[ends[long] - self.length + 1] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        new = inside.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        new[starts[long]] = True
        first = np.flatnonzero(new)
        size = np.diff(np.append(np.cumsum(inside)[first] - 1, inside.sum()))
        return np.searchsorted(ends, first, "right"), first, size, anchor[first] - first, hashes[anchor[first]]


def sorted_pieces(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted suffixes of all pieces of symbols, built one symbol of every piece at a time, from the last one on.

    Pieces that end alike have their suffixes in one row. Returned are, by row in that order, the row of the suffix
    without its first symbol, and the symbols it shares with the row before; and the row of each whole piece. Row 0 is
    the empty suffix.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    text = np.concatenate([np.empty(0, np.int64), *pieces])
    n_symbols = int(text.max(initial=0)) + 1
    last = np.cumsum(sizes) - 1
    row, shared = np.zeros(len(pieces), np.int32), np.zeros(1, np.int32)
    # By row after the empty one, the row of the suffix without its first symbol; ``heads`` tells where each symbol's rows begin.
    rest, heads = np.empty(0, np.int32), np.zeros(n_symbols + 1, np.int64)
    for done in range(int(sizes.max(initial=0))):
        active = np.flatnonzero(sizes > done)
        key, back = np.unique(text[last[active] - done] << 32 | row[active], return_inverse=True)
        symbol, q, k = key >> 32, key.astype(np.int32), len(key)
        same = np.concatenate(([False], symbol[1:] == symbol[:-1], [False]))
        place = np.empty(k, np.int64)
        bounds = np.flatnonzero(~same)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            low, high = heads[symbol[a]], heads[symbol[a] + 1]
            place[a:b] = low + np.searchsorted(rest[low:high], q[a:b])
        # The rests of the rows before and after with the same first symbol, old or new; -1 if there is none.
        before, after = np.full(k, -1, np.int32), np.full(k, -1, np.int32)
        old = place > heads[symbol]
        before[old] = rest[place[old] - 1]
        before[1:] = np.where(same[1:-1], np.maximum(before[1:], q[:-1]), before[1:])
        old = place < heads[symbol + 1]
        after[old] = rest[place[old]]
        new = np.concatenate((same[1:-1] & ((after[:-1] < 0) | (q[1:] < after[:-1])), [False]))
        after[new] = -1
        # Suffixes that begin alike share one symbol more than their rests do: the least over the rows between.
        has_before, has_after = before >= 0, after >= 0
        low, high = np.concatenate((before[has_before], q[has_after])) + 1, np.concatenate((q[has_before], after[has_after])) + 1
        by, n = np.argsort(low), 1 + len(rest)
        between = np.empty(len(low), np.int32)
        if len(low):
            pairs = np.stack((low[by], high[by]), 1).ravel()
            between[by] = np.minimum.reduceat(np.append(shared, np.int32(0)), pairs)[::2]
        own, some = np.zeros(k, np.int32), int(has_before.sum())
        own[has_before] = between[:some] + 1
        shared[1 + place[has_after]] = between[some:] + 1
        # New rows move those behind them.
        at = place + np.arange(k)
        moved = np.repeat(np.arange(k + 1, dtype=np.int32), np.diff(np.concatenate(([0], 1 + place, [n]))))
        moved = np.append(moved, np.int32(k))
        keep = np.ones(n + k, bool)
        keep[1 + at] = False
        longer, grown = np.empty(n + k, np.int32), np.empty(n + k - 1, np.int32)
        longer[keep], longer[1 + at] = shared, own
        rest += moved[rest]
        grown[keep[1:]], grown[at] = rest, q + moved[q]
        row += moved[row]
        row[active] = 1 + at[back]
        rest, shared = grown, longer
        heads[1:] += np.cumsum(np.bincount(symbol, minlength=n_symbols))
    return np.concatenate(([0], rest)), shared, row


def repeated_starts(pieces: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each piece, the starts whose string of ``length`` symbols begins at another start of these pieces too."""
    if not pieces:
        return []
    rest, shared, row = sorted_pieces(pieces)
    again = np.append(shared >= length, False)
    again = again[:-1] | again[1:]
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    at = np.full((len(pieces), max(1, int(sizes.max()) - length + 1)), len(again))
    for i in range(at.shape[1]):
        active = sizes >= i + length
        at[active, i] = row[active]
        row[active] = rest[row[active]]
    # A row may also stand for suffixes of several pieces that end alike.
    again |= np.bincount(at.ravel(), minlength=len(again) + 1)[:-1] > 1
    return [np.flatnonzero(f) for f in np.append(again, False)[at]]


def digests(raw: bytes, starts, sizes) -> np.ndarray:
    """128-bit hashes of parts of ``raw``, as two longs each."""
    whole = b"".join([xxhash.xxh3_128_digest(raw[a : a + n]) for a, n in zip(starts, sizes)])
    return np.frombuffer(whole, np.int64).reshape(-1, 2)


def runs(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending starts as runs: the first bytes and the ends of the strings' union."""
    if not len(starts):
        return starts, starts
    head = np.concatenate(([True], np.diff(starts) > 1))
    return starts[head], starts[np.concatenate((head[1:], [True]))] + length


def text_class(text) -> list:
    """Two longs that stand for a text: the halves of its MD5."""
    digest = F.md5(text)
    return [F.conv(F.substring(digest, a, 16), 16, -10).cast("long") for a in (1, 17)]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(c1, c2, copies, body): each text once, as bytes, null as empty; copies merge before the shuffle. A written table."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    c1, c2 = text_class(F.col("body"))
    keyed = docs.select(body.alias("body")).select(c1.alias("c1"), c2.alias("c2"), "body")
    return stage(keyed.groupBy("c1", "c2").agg(F.count("*").alias("copies"), F.first("body").alias("body")), "texts")


def find_pieces(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(c1, c2, weight, pieces): the pieces of each text; weight 2 stands for any number of copies above 1. A written table."""
    names, kind = ["c1", "c2", "copies", "pieces"], "c1 long, c2 long, copies long, pieces array<struct<start:long,size:int,place:int,key:long,d1:long,d2:long>>"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        for batch in batches:
            body = batch["body"]
            offsets = np.frombuffer(body.buffers()[1], np.int32 if pa.types.is_binary(body.type) else np.int64)[body.offset : body.offset + len(body) + 1].astype(np.int64)
            buffer = body.buffers()[2]
            data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
            a = 0
            while a < len(body):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PART_BYTES, "right")) - 1)
                for low in range(offsets[a], max(offsets[a] + 1, offsets[b] - (length - 1) * (b == a + 1)), PART_BYTES):
                    high = min(offsets[b], low + PART_BYTES + length - 1)
                    part = data[low:high]
                    ends = offsets[a + 1 : b + 1] - low if b > a + 1 else np.array([len(part)])
                    of, first, size, place, key = anchors.pieces(part, ends)
                    half = digests(part.tobytes(), first.tolist(), (size + length - 1).tolist())
                    starts = first + low - offsets[a + of]
                    lists = pa.StructArray.from_arrays(
                        [pa.array(starts, pa.int64()), pa.array(size, pa.int32()), pa.array(place, pa.int32()), pa.array(key.view(np.int64)), pa.array(half[:, 0].copy()), pa.array(half[:, 1].copy())], PIECE)
                    counts = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=b - a))))
                    yield pa.RecordBatch.from_arrays([*(batch[c][a:b] for c in ("c1", "c2", "copies")), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), lists)], names)
                a = b

    found = texts.where(F.octet_length("body") >= length).mapInArrow(look, kind).where(F.size("pieces") > 0)
    return stage(found.select("c1", "c2", F.least("copies", F.lit(2)).alias("weight"), "pieces"), "pieces")


def bodies_of(variants: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(c1, c2, copies, place, body): the bytes of each variant, under its own digest, and where its anchor is. A written table."""
    lists = variants.groupBy("c1", "c2").agg(F.collect_list(F.struct("d1", "d2", "n", "place", "start", "size")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, wanted in zip(batch["body"], batch["wanted"]):
                raw, fields = memoryview(body.as_buffer()), wanted.values.flatten()
                for i in range(0, len(fields[0]), 4096):
                    d1, d2, n, place, start, size = (f[i : i + 4096] for f in fields)
                    cuts = [raw[a : a + b + length - 1] for a, b in zip(start.to_pylist(), size.to_pylist())]
                    yield pa.RecordBatch.from_arrays([d1, d2, n, place, pa.array(cuts, pa.binary())], ["c1", "c2", "copies", "place", "body"])

    joined = texts.select("c1", "c2", "body").join(lists, ["c1", "c2"]).select("body", "wanted")
    return stage(joined.mapInArrow(cut, "c1 long, c2 long, copies long, place int, body binary"), "bodies")


def judge(variants: DataFrame, texts: DataFrame, length: int, gram: int, block_pieces: int, block_symbols: int) -> DataFrame:
    """(c1, c2, spans): of each variant that occurs once, by its digest, the strings that other variants of its anchor have too.

    Anchors with up to ``block_pieces`` variants are sorted in blocks. Those with more would fill a task, so their
    strings are compared one by one through their hashes, which merge before the shuffle; the answer is the same.
    """
    keys = variants.select("key", F.col("d1").alias("c1"), F.col("d2").alias("c2"))
    wide = stage(keys.groupBy("key").agg(F.count("*").alias("v")).select("key", (F.col("v") > block_pieces).alias("wide")), "widths")
    bodies = stage(bodies_of(variants, texts, length).join(keys, ["c1", "c2"]).join(wide, "key"), "keyed-bodies")
    names, kinds = ["c1", "c2", "spans"], [pa.int64()] * 2 + [pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def told():
            anchors: dict[bytes, int] = {}
            pieces = [np.concatenate((np.frombuffer(body[:at], np.uint8), [anchors.setdefault(body[at : at + gram], 256 + len(anchors))], np.frombuffer(body[at + gram :], np.uint8)))
                      for *_, at, body in rows]
            found = repeated_starts([p.astype(np.int64) for p in pieces], length - gram + 1)
            out = [(r[1], r[2], [{"from": a, "to": b} for a, b in zip(*(x.tolist() for x in runs(f, length)))]) for r, f in zip(rows, found) if r[3] == 1 and len(f)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 3, kinds)], names)

        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("key", "c1", "c2", "copies", "place", "body"))):
                if size >= block_symbols and r[0] != rows[-1][0]:
                    yield told()
                    rows, size = [], 0
                rows.append(r)
                size += len(r[5]) - gram + 1
        if rows:
            yield told()

    kind = "c1 long, c2 long, spans array<struct<from:long,to:long>>"
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = bodies.where(~F.col("wide")).repartition(n, "key").sortWithinPartitions("key").mapInArrow(sort, kind)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c1, c2, copies, raw in zip(*(batch[c].to_pylist() for c in ("c1", "c2", "copies", "body"))):
                halves = digests(raw, range(len(raw) - length + 1), [length] * (len(raw) - length + 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(halves), x)) for x in (c1, c2, copies)] + [pa.array(np.arange(len(halves)))] + [pa.array(halves[:, i].copy()) for i in (0, 1)], ["c1", "c2", "copies", "i", "h1", "h2"])

    each = bodies.where("wide").mapInArrow(strings, "c1 long, c2 long, copies long, i long, h1 long, h2 long")
    again = each.groupBy("h1", "h2").agg(F.sum("copies").alias("all")).where(F.col("all") > 1).drop("all")
    span = F.struct(F.col("i").alias("from"), (F.col("i") + length).alias("to"))
    compared = each.where("copies = 1").join(again, ["h1", "h2"], "left_semi").groupBy("c1", "c2").agg(F.collect_list(span).alias("spans"))
    return stage(sorted_.unionByName(compared), "found")


def repeats(texts: DataFrame, length: int = LENGTH, grams: tuple[int, ...] = GRAMS, block_pieces: int = BLOCK_PIECES, block_symbols: int = BLOCK_SYMBOLS) -> DataFrame:
    """(c1, c2, spans): for each text with ``copies`` 1 in (c1, c2, copies, body), the runs of bytes that also stand elsewhere.

    Runs are as many as pieces have; they may touch and overlap, and are in no order. ``grams`` are the lengths of anchors, less than ``length``.
    """
    pieces = find_pieces(texts, length, grams[0])
    each = pieces.select("c1", "c2", "weight", F.inline("pieces"))
    shared = each.groupBy("key").agg(F.sum("weight").alias("all")).where(F.col("all") > 1).select("key")
    shared = stage(shared, "shared")
    held = stage(each.join(shared, "key"), "held")
    release(pieces, shared)
    variants = stage(held.groupBy("key", "d1", "d2").agg(F.least(F.sum("weight"), F.lit(2)).alias("n"), *[F.first(c).alias(c) for c in ("c1", "c2", "start", "size", "place")]), "variants")
    mixed = variants.groupBy("key").agg(F.count("*").alias("v"), F.min("n").alias("least")).where((F.col("v") > 1) & (F.col("least") == 1)).select("key")
    mixed = stage(variants.join(mixed, "key"), "mixed")
    if grams[1:]:
        found = repeats(bodies_of(mixed, texts, length), length, grams[1:], block_pieces, block_symbols)
    else:
        found = judge(mixed, texts, length, grams[0], block_pieces, block_symbols)
    found = found.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), "spans")
    told = variants.select("d1", "d2", "n").join(found, ["d1", "d2"], "left").where((F.col("n") > 1) | F.col("spans").isNotNull())
    spans = held.where("weight = 1").select("c1", "c2", "start", "size", "d1", "d2").join(stage(told, "told"), ["d1", "d2"])
    # A piece that stands twice is repeated as a whole.
    whole = F.array(F.struct(F.col("start").alias("from"), (F.col("start") + F.col("size") - 1 + length).alias("to")))
    part = F.transform("spans", lambda s: F.struct((s["from"] + F.col("start")).alias("from"), (s["to"] + F.col("start")).alias("to")))
    return spans.groupBy("c1", "c2").agg(F.flatten(F.collect_list(F.when(F.col("n") > 1, whole).otherwise(part))).alias("spans"))


def removals(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """(c1, c2, n_removed, kept_sha256, spans): per text from which bytes go, the maximal removed runs in order, and the rest's digest.

    Rows without text, with an empty one or with fewer bytes than ``length`` lose nothing; texts of that length
    or more that stand in several rows lose all. Only ``text`` is read. An empty table gives no rows.
    """
    texts = distinct_texts(docs)
    kind = "c1 long, c2 long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    names = ["c1", "c2", "n_removed", "kept_sha256", "spans"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c1, c2, body, spans in zip(*(batch[c] for c in ("c1", "c2", "body", "spans"))):
                raw, fields = memoryview(body.as_buffer()), spans.values
                low, high = (fields.field(i).to_numpy() for i in (0, 1))
                order = np.argsort(low)
                low, high = low[order], np.maximum.accumulate(high[order])
                head = np.concatenate(([True], low[1:] > high[:-1]))
                low, high = low[head], high[np.concatenate((head[1:], [True]))]
                digest = hashlib.sha256()
                for a, b in zip([0, *high.tolist()], [*low.tolist(), len(raw)]):
                    digest.update(raw[a:b])
                merged = [{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist())]
                columns = [[c1.as_py()], [c2.as_py()], [int((high - low).sum())], [digest.hexdigest()], [merged]]
                kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    single = texts.where("copies = 1").select("c1", "c2", "body").join(repeats(texts, length, **options), ["c1", "c2"]).mapInArrow(cut, kind)
    n = F.octet_length("body").cast("long")
    gone = F.array(F.struct(F.lit(0).cast("long").alias("start"), n.alias("end")))
    several = texts.where((F.col("copies") > 1) & (F.octet_length("body") >= length)).select("c1", "c2", n.alias("n_removed"), F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"), gone.alias("spans"))
    return stage(single.unionByName(several), "removals")


def keep_unrepeated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; what is left of a cut character becomes U+FFFD. Null stays null.

    All rows and columns stay, whatever their names.
    """
    cut = removals(docs, **options).select("c1", "c2", "spans")
    c1, c2 = text_class(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), c1.alias("c1"), c2.alias("c2")).join(cut, ["c1", "c2"], "left")
    left = F.expr("""make_valid_utf8(CAST(aggregate(spans, named_struct('at', 0L, 'out', CAST('' AS binary)), (acc, x) ->
      named_struct('at', x.end, 'out', concat(acc.out, substring(CAST(row.text AS binary), CAST(acc.at AS INT) + 1, CAST(x.start - acc.at AS INT)))),
      acc -> concat(acc.out, substring(CAST(row.text AS binary), CAST(acc.at AS INT) + 1))) AS string))""")
    return rows.select(*[(F.when(F.col("spans").isNull(), F.col("row")["text"]).otherwise(left) if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Per document, what is removed of it; null texts count as empty, repeated rows each have theirs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = removals(docs)
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    c1, c2 = text_class(body)
    rows = docs.select("doc_id", F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("own"), c1.alias("c1"), c2.alias("c2"))
    spans = F.expr("array_join(transform(spans, s -> concat(s.start, ':', s.end)), ',')")
    return rows.join(cut, ["c1", "c2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "own").alias("kept_sha256"), F.coalesce(spans, F.lit("")).alias("spans"),
    )
