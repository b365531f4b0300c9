"""Near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has a number of coordinates. In each of the first rounds, a hash puts
every shingle into one coordinate, with the round and a hash as its value, and
the smallest value stays; as soon as all coordinates have one, the text is
done. In the last rounds each coordinate in turn takes in every shingle, so
none stays empty, whatever the size of the set. Two sets agree at a coordinate
with the probability of their similarity, and the number of agreements is
concentrated around its mean.

Texts with the same set are one class. Classes that agree in a band are
compared with the most central class of the band's bucket, the one with the
most neighbours over all its buckets, on their full sets, so a bucket of any
size gives as many pairs as it has members. After the links found so far are
joined into components, members outside the largest component of their bucket
are compared with a few others of it, spread over the buckets. The classes of
buckets still apart then are compared across components by prefix: the
shingles of each stand in one order, rare ones first, and two sets similar
enough share one of their first shingles, early enough to leave room for the
rest. Copies that differ from all others by enough shingles of their own
thus meet nobody, and no link is left out.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.common import WordHashes, chunks, fresh, mix
from airq.llm.shingles import shingle_sets
from airq.sources.staging import stage

BANDS, ROWS = 32, 5
PERCENT = 80
#: Members of a bucket's largest component that those outside are compared with before all are.
HUBS = 8
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(values: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """One row of ``width`` coordinates per set; sets without elements stay empty."""
    sketch = np.full((len(sizes), width), _EMPTY)
    flat = sketch.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for i in range(2 * width):
        if not len(values):
            break
        h = mix(values + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = np.uint64(i << 52) | (h >> np.uint64(12))
        if i < width:
            np.minimum.at(flat, owner * width + ((h & np.uint64(0xFFFFFF)) % np.uint64(width)).astype(np.int64), value)
        else:
            np.minimum.at(flat, owner * width + (i - width), value)
        open_ = (sketch[owner[np.concatenate(([True], owner[1:] != owner[:-1]))]] == _EMPTY).any(1)
        left = np.zeros(len(sizes), bool)
        left[np.unique(owner)] = open_
        keep = left[owner]
        if not keep.all():
            values, owner = values[keep], owner[keep]
    return sketch


def band_hashes(sketch: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    h = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(sketch), 0)
    for j in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sketch[:, j : bands * rows : rows])
    return h


def sketched(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Per row: doc_id, text_hash, number of shingles, the class (a hash of the set), band hashes; the last two null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in chunks(texts):
                values, sizes = shingle_sets(texts[a:b], words, known)
                h = band_hashes(sketches(values, sizes, bands * rows), bands, rows)
                ends = np.cumsum(sizes)
                keys = [int.from_bytes(hashlib.blake2b(values[e - n : e].tobytes(), digest_size=8).digest(), "little", signed=True) if n else None for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][a:b], batch["text_hash"][a:b], pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                     pa.array([r if n else None for r, n in zip(h.view(np.int64), sizes)], pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "n_shingles", "class", "bands"],
                )

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows_in.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, class long, bands array<long>")


def similar(pairs: DataFrame, pool: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) of classes those whose full sets have ``percent`` of similarity or more; ``pool`` has a text per class."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, recent = WordHashes(), OrderedDict()

        def of(key, text):
            if key not in recent:
                recent[key] = shingle_sets([text], words, known)[0]
                while len(recent) > 500 or sum(map(len, recent.values())) > 2_000_000 and len(recent) > 2:
                    recent.popitem(last=False)
            recent.move_to_end(key)
            return recent[key]

        for batch in batches:
            good = []
            for a, b, x, y in zip(*(batch[c].to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                x, y = of(a, x), of(b, y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    text = {side: pool.select(F.col("class").alias(side), F.col("text").alias(f"text_{side}")) for side in ("a", "b")}
    joined = pairs.join(text["b"], "b").join(text["a"], "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the smallest node it can reach.

    Every round takes the smallest label among the neighbours and then the label of that
    label, which halves the way; it ends when nothing changes. Each round is a written table.
    """
    edges = stage(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = step.select(F.col("node").alias("j"), F.col("label").alias("far"))
        new = stage(step.join(jump, F.col("label") == F.col("j")).select("node", "was", F.least("label", "far").alias("label")), "labels")
        if new.where(F.col("label") != F.col("was")).isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def apart(inside: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that have several components, with their labels."""
    told = inside.join(labels, inside["class"] == labels["node"], "left").select("bucket", "class", "n_shingles", "place", F.coalesce("label", "class").alias("label"))
    several = told.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")
    return told.join(several, "bucket")


def hubs(inside: DataFrame, largest: DataFrame) -> DataFrame:
    """Up to ``HUBS`` members of each bucket's largest component, others in each bucket: the smallest hash in each part."""
    main = inside.join(largest, "bucket").where("label = main")
    spread = F.xxhash64("class", "bucket")
    one = main.groupBy("bucket", F.pmod(spread, F.lit(HUBS)).alias("part")).agg(F.min(F.struct(spread.alias("s"), "class", "n_shingles", "place", "label")).alias("m"))
    return one.select("bucket", "m.class", "m.n_shingles", "m.place", "m.label")


def prefixes(classes: DataFrame, pool: DataFrame, words: int, percent: int) -> DataFrame:
    """(bucket, class, n_shingles, place): the first shingles of each of ``classes`` in one common order, rare ones first, and their places from 1.

    Two sets with ``percent`` of similarity share one of them. Shingles that only one class
    has take their places but are left out, as they match nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in chunks(texts):
                values, sizes = shingle_sets(texts[a:b], words, known)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                yield pa.RecordBatch.from_arrays([batch["class"][a:b], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))], ["class", "shingles"])

    sets = stage(pool.join(classes, "class", "left_semi").select("class", "text").mapInArrow(run, "class long, shingles array<long>"), "shingles")
    each = sets.select("class", F.size("shingles").cast("long").alias("n_shingles"), F.explode("shingles").alias("bucket"))
    common = each.groupBy("bucket").agg(F.count("*").alias("df")).where("df > 1")
    ordered = each.join(common, "bucket").groupBy("class", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("df", "bucket"))).alias("s"))
    own = F.col("n_shingles") - F.size("s")
    length = F.col("n_shingles") - F.expr(f"({percent} * n_shingles + 99) div 100") + 1
    first = ordered.select("class", "n_shingles", own.alias("own"), F.slice("s", F.lit(1), F.greatest(F.lit(0), length - own).cast("int")).alias("s"))
    return first.select("class", "n_shingles", "own", F.posexplode("s").alias("at", "e")).select(F.col("e.bucket").alias("bucket"), "class", "n_shingles", (F.col("own") + F.col("at") + 1).alias("place"))


def groups(docs: DataFrame, words: int = 5, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_shingles, class, label (of the component), component_id.

    Links hold where intersection and union of the shingle sets are at ``percent`` or more;
    each is confirmed on the sets. With the defaults, two sets at exactly 0.8 share no band
    with a probability of 3 in a million, more similar ones with less. The component is the
    smallest doc_id that links reach. A null id is larger than all others; null and wordless
    texts have no class, link with nothing and are their own component. Rows that repeat are members
    of one class. Classes are told apart by 64 bits of a hash of their set.
    """
    rows_ = stage(sketched(docs, words, bands, rows), "sketches")
    classes = stage(
        rows_.where("class IS NOT NULL").groupBy("class").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n_shingles")).alias("r"))
        .select("class", "r.doc_id", "r.text_hash", "r.n_shingles"), "classes")
    # A class's rows have the same bands; the row that stands for it gives them once.
    rep = (rows_.join(classes.select("class", F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash")), "class")
           .where(F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash"))))
    member = stage(rep.select("class", "n_shingles", "bands"), "members")
    member = member.select("class", "n_shingles", F.posexplode("bands").alias("band", "h")).select("class", "n_shingles", F.xxhash64("band", "h").alias("bucket"))
    shared = stage(
        member.groupBy("bucket").agg(F.count("*").alias("n"), F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("bucket", "n"), "buckets")
    inside = stage(member.join(shared, "bucket"), "inside")
    near = inside.groupBy("class").agg(F.sum("n").alias("near"))
    central = inside.join(near, "class").groupBy("bucket").agg(F.max(F.struct("near", "class")).alias("m")).select("bucket", F.col("m.class").alias("hub"))
    inside = stage(inside.join(central, "bucket").select("bucket", "class", "n_shingles", "hub"), "inside")
    # One text for each class that shares a bucket; of rows that repeat, any will do.
    rep = classes.join(inside.select("class").distinct(), "class", "left_semi").select("class", F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"))
    texts = docs.select(F.col("doc_id").cast("long").alias("t_id"), F.xxhash64("text").alias("t_hash"), "text")
    pool = rep.join(texts, (F.col("t_hash") == F.col("r_hash")) & F.col("t_id").eqNullSafe(F.col("r_id"))).select("class", "text")
    pool = stage(pool.dropDuplicates(["class"]), "pool")

    # First every member with the bucket's most central class.
    tried = stage(inside.where("class <> hub").select(F.least("hub", "class").alias("a"), F.greatest("hub", "class").alias("b")).distinct(), "pairs")
    links = stage(similar(tried, pool, words, percent), "links")
    inside = inside.select("bucket", "class", "n_shingles", F.lit(1).cast("long").alias("place"))
    for last in (False, True):
        # Then members outside the bucket's largest component, with some of its members; last, across components by prefix.
        labels = components(links)
        if last:
            inside = prefixes(apart(inside, labels).select("class").distinct(), pool, words, percent)
        inside = stage(apart(inside, labels), "open")
        part = inside.groupBy("bucket", "label").agg(F.count("*").alias("n"))
        largest = part.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("m")).select("bucket", F.col("m.label").alias("main"))
        few = inside.join(largest, "bucket").where("label <> main").select("bucket", F.col("class").alias("x"), F.col("n_shingles").alias("nx"), F.col("place").alias("px"), F.col("label").alias("lx"))
        partners = inside if last else hubs(inside, largest)
        # What both can have in common from their places on.
        room = F.least(F.col("nx") - F.col("px"), F.col("n_shingles") - F.col("place")) + 1
        fits = (room * (100 + percent) >= percent * (F.col("nx") + F.col("n_shingles"))) & (F.col("lx") != F.col("label"))
        across = few.join(partners, "bucket").where(fits).select(F.least("x", "class").alias("a"), F.greatest("x", "class").alias("b")).distinct()
        across = stage(across.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.unionAll(across)
        links = stage(links.unionAll(similar(across, pool, words, percent)), "links")
        inside = inside.select("bucket", "class", "n_shingles", "place")
    labels = components(links)

    home = classes.join(labels, classes["class"] == labels["node"], "left").select("class", F.coalesce("label", "class").alias("label"), "doc_id")
    first = home.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    home = home.join(first, "label").select(F.col("class").alias("c"), "label", "component_id")
    out = rows_.select("doc_id", "text_hash", "n_shingles", "class").join(home, F.col("class") == F.col("c"), "left")
    return out.select("doc_id", "text_hash", "n_shingles", "class", "label", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """Stage: of each component, the row with the smallest doc_id, and all rows without words.

    Of rows that share that id and component, one stays: the one with the smallest text hash. A
    component that has null ids only keeps one row. Columns stay as they are.
    """
    columns = docs.columns
    found = groups(docs, **options)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("r")
    kept = found.where("class IS NOT NULL").groupBy("label").agg(least).select(F.col("r.doc_id").alias("k_id"), F.col("r.text_hash").alias("k_hash"))
    kept = kept.unionAll(found.where("class IS NULL").select("doc_id", "text_hash")).distinct()
    row, = fresh(docs, "row")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias(row), F.col("doc_id").cast("long").alias("d_id"), F.xxhash64("text").alias("d_hash"),
                         F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("has_words"))
    picked = marked.join(kept, F.col("d_id").eqNullSafe(F.col("k_id")) & (F.col("d_hash") == F.col("k_hash")), "left_semi")
    worded = picked.where("has_words")
    order = worded.withColumn("twin", F.xxhash64("d_id", "d_hash"))
    single = order.groupBy("twin", "d_id", "d_hash").agg(F.first(row).alias(row))
    return single.select(row).unionAll(picked.where("NOT has_words").select(row)).select(*[F.col(row)[c].alias(c) for c in columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return groups(docs, words=4).select("doc_id", "n_shingles", "component_id", (F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"))


SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS g
  FROM w WHERE ws IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(r.m, d.doc_id), d.doc_id) AS component_id,
  coalesce(least(r.m, d.doc_id), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.a = d.doc_id
"""
