"""Order MinHash fingerprints, sensitive to edits and to the order of what is shared.

A text's words are its pieces; those of more than 16 characters are cut where the
hash of two neighbouring characters is the least of five in a row, so pieces fall
into step again after an edit. Three pieces in a
row are a k-mer, and each k-mer carries the number of its earlier occurrences.
A hash puts each numbered k-mer into one of 32 bins; the two smallest of a bin
are put back into text order and hashed together. The bins' values are the
fingerprint. One hash with bins stands for 32 hashes over all k-mers, as in
one-permutation hashing, so a text is sorted twice and no more. Everything is
DataFrame and SQL functions within one row; only neighbours need a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 3
#: A longer word is cut, after each pair of characters whose hash none of so many on either side is below.
WORD, BESIDE = 16, 2
#: A position takes 24 bits of a number, a k-mer's hash the other 40.
LOW = (1 << 24) - 1
BIN_SHIFT, BINS = 59, 32


def fingerprint(text: str) -> Column:
    """Sorted array of numbers below 2^32, one per bin in use: 5 bits of the bin, 27 of its hash.

    Null, empty and blank texts have none. A text of fewer than three pieces has one k-mer of all of them.
    Up to 16,777,216 pieces have positions of their own.
    """
    high = ~LOW
    let = "transform(array({value}), {name} -> {body})[0]".format  # names a value once, so that it is computed once
    bin_ = f"shiftright({{}}, {BIN_SHIFT})".format
    hash_ = "shiftright({}, 24)".format
    kmers = f"""sort_array(transform(slice(t, 1, greatest(size(t) - {K - 1}, least(size(t), 1))), (w, i) -> (xxhash64(w, get(t, i + 1), get(t, i + 2)) & {high}L) | i))"""
    starts = f"filter(IF(size(p) = 0, CAST(array() AS array<int>), sequence(0, size(p) - 1)), j -> j = 0 OR {hash_('get(p, j)')} <> {hash_('get(p, j - 1)')})"
    numbered = f"""sort_array(flatten(transform(s, (a, r) -> transform(sequence(a, coalesce(get(s, r + 1), size(p)) - 1),
        j -> (xxhash64({hash_('get(p, j)')}, j - a) & {high}L) | (get(p, j) & {LOW}L)))))"""
    least = f"filter(v, (x, j) -> j < 2 OR {bin_('x')} <> {bin_('get(v, j - 2)')})"
    heads = f"filter(IF(size(e) = 0, CAST(array() AS array<int>), sequence(0, size(e) - 1)), j -> j = 0 OR {bin_('get(e, j)')} <> {bin_('get(e, j - 1)')})"
    pair = f"""IF(coalesce({bin_('get(e, j + 1)')} = {bin_('get(e, j)')}, false),
        IF((get(e, j) & {LOW}L) <= (get(e, j + 1) & {LOW}L), xxhash64({hash_('get(e, j)')}, {hash_('get(e, j + 1)')}), xxhash64({hash_('get(e, j + 1)')}, {hash_('get(e, j)')})),
        xxhash64({hash_('get(e, j)')}))"""
    values = f"transform({heads}, j -> shiftleft({bin_('get(e, j)')} + 16L, 27) | ({pair} & {(1 << 27) - 1}L))"
    body = let(value=least, name="e", body=values)
    body = let(value=numbered, name="v", body=body)
    body = let(value=starts, name="s", body=body)
    body = let(value=kmers, name="p", body=body)
    beside = ", ".join(f"get(g, i + ({d}))" for d in range(-BESIDE, BESIDE + 1))
    cut = let(value="transform(c, (x, i) -> xxhash64(x, get(c, i + 1)))", name="g", body=f"array_join(transform(c, (x, i) -> IF(get(g, i) <= least({beside}), concat(x, ' '), x)), '')")
    cut = f"IF(char_length(w) <= {WORD}, w, {let(value="split(w, '')", name='c', body=cut)})"
    spaced = rf"IF(y RLIKE r'\S{{{WORD + 1}}}', array_join(transform(regexp_extract_all(y, r'\S+', 0), w -> {cut}), ' '), y)"
    pieces = let(value=f"coalesce({text}, '')", name="y", body=rf"regexp_extract_all({spaced}, r'\S+', 0)")
    return F.expr(let(value=pieces, name="t", body=body))


def as_text(values: str) -> Column:
    """Eight hexadecimal digits per bin in use."""
    return F.expr(f"array_join(transform({values}, c -> lpad(lower(hex(c)), 8, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """Share of the bins in use on either side that agree; 1 for two texts without k-mers."""
    used = f"size(array_union(transform({a}, c -> shiftright(c, 27)), transform({b}, c -> shiftright(c, 27))))"
    return F.expr(f"IF({used} = 0, 1.0D, CAST(size(array_intersect({a}, {b})) AS double) / greatest({used}, 1))")


def with_next(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Adds ``next_<c>`` for the carried columns: of the next row by descending doc_id, of the first after the last.

    ``rows`` needs doc_id and tie; equal ids go by descending tie, null ids come last. Ids are cut into
    buckets at their quantiles; each bucket also gets the first row of the next one, so that no order
    over all rows is needed.
    """
    spark = rows.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    inside = F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("doc_id"))), F.lit(0)) if cuts else F.lit(0)
    placed = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(inside))
    heads = placed.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("h")).select("bucket", "h.doc_id", "h.tie").collect()  # one row per bucket
    if not heads:
        return rows.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    heads.sort(key=lambda r: -r["bucket"])
    home = [(r["doc_id"], r["tie"], heads[i - 1]["bucket"]) for i, r in enumerate(heads)]
    home = F.broadcast(spark.createDataFrame(home, "h_id long, h_tie long, h_bucket int"))
    first = rows.join(home, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("tie") == F.col("h_tie"))).withColumn("bucket", F.col("h_bucket")).drop("h_id", "h_tie", "h_bucket")
    all_ = placed.withColumn("guest", F.lit(False)).unionByName(first.withColumn("guest", F.lit(True)))
    order = W.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return all_.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried]).where("NOT guest").drop("bucket", "guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text, n_chars, edited, and the fingerprints of the text, the edited and the next one.

    The edited text has its last floor(n_chars / 2) code points replaced by as many of the next
    document's first, or all it has. Null texts count as empty. Rows that repeat are rows of their own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    # Neighbours are found on all columns at once, so a text is shuffled once; its fingerprint goes with it.
    rows = with_next(rows.withColumn("print", fingerprint("text")), ["text", "print"])
    half = "CAST(floor(char_length(text) / 2) AS int)"
    rows = rows.withColumn("n_chars", F.expr("CAST(char_length(text) AS long)")).withColumn("edited", F.expr(f"concat(substring(text, 1, char_length(text) - {half}), substring(next_text, 1, {half}))"))
    return rows.select("doc_id", "text", "n_chars", "edited", "print", fingerprint("edited").alias("edited_print"), "next_print")


def query(spark, sf_dir: str) -> DataFrame:
    told = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return told.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("print").alias("fingerprint"), as_text("edited_print").alias("edited_fingerprint"),
        likeness("print", "edited_print").alias("near_edited"), likeness("print", "next_print").alias("near_next"),
    )
