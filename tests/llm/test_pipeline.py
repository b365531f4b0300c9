"""The pipeline's stages keep columns, act on what they get, and the SQL twins agree."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from airq.llm.queries import QUERIES, SQL
from airq.session import BATCH_LIMIT, bound_batches
from checks.compare import _rows, connect


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, sf)
    cursor = connect(sf).execute(SQL[name])
    assert _rows(df.columns, df.collect()) == _rows([d[0] for d in cursor.description], cursor.fetchall())


def test_stages(spark, docs):
    passage = " ".join(f"word{i}" for i in range(80))
    rows = [(1, f"the first text {passage}", "en"), (2, f"{passage} and some more of it", "en"), (3, "12345 %%%", "en"), (4, None, None),
            (5, "a small text that has a token = \"0123456789abcdef0123\" in it", "en"), (6, "a small text that has a token = \"0123456789abcdef0123\" in it", "en"),
            (7, "clean and short", "en")]
    rng = random.Random(1)
    common = "the first text and some more of it a small that has in clean short token word".split()
    rows += [(i, " ".join(rng.choices(common, k=14)), "en") for i in range(20, 60)]
    more = set(range(20, 60))
    table, seen = docs(rows), {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        columns = table.columns
        table = function(spark, table, "")
        assert table.columns == columns
        table = spark.createDataFrame(table.collect(), table.schema)
        seen[name] = {r["doc_id"]: r["text"] for r in table.collect()}
    assert set(seen["language"]) == {1, 2, 5, 6, 7} | more
    assert seen["line_dedup"][2] == " and some more of it" and seen["line_dedup"][1] == rows[0][1]
    assert set(seen["near_dedup"]) == {1, 2, 5, 7} | more
    assert seen["secrets"][5] == 'a small text that has a [SECRET]" in it' and seen["secrets"][7] == "clean and short"
    packed = corpus_pipeline.STAGES[-1][1](spark, table, "").collect()
    assert {r["doc_id"] for r in packed} == {1, 2, 5, 7} | more and len({r["sequence_id"] for r in packed}) == 1


@pytest.mark.parametrize("name", ["language", "line_dedup", "near_dedup", "packing"])
def test_texts_go_to_python_in_small_batches(spark, docs, name):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["size", "rows"])

    def seen():
        texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("some text "), 1000).alias("text"))
        return [tuple(r) for r in texts.mapInArrow(sizes, "size long, rows long").collect()]

    before = spark.conf.getAll.get(BATCH_LIMIT)
    try:
        spark.conf.unset(BATCH_LIMIT)
        dict(corpus_pipeline.STAGES)[name](spark, docs([(1, "one text", "en"), (2, "another", "en")]), "")
        assert max(size for size, _ in seen()) < 6_000_000 and sum(n for _, n in seen()) == 3000
        spark.conf.set(BATCH_LIMIT, "1m")
        bound_batches(spark)
        assert max(size for size, _ in seen()) < 2_000_000
    finally:
        spark.conf.unset(BATCH_LIMIT) if before is None else spark.conf.set(BATCH_LIMIT, before)


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
