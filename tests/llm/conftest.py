import pytest
from pyspark.sql import functions as F

KINDS = "doc_id long, text string, lang string, source string, n_chars long, row_ string, found int, `class` string, text_hash string"


@pytest.fixture
def docs(spark):
    """Makes documents with columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, t, lang, "s", None if t is None else len(t), "x", 1, "c", "h") for i, t, lang in rows]
        return spark.createDataFrame(full, KINDS)

    return make


@pytest.fixture
def edge(docs):
    """Nulls, empty, blank and repeated rows, and a long text of one word."""
    return docs([
        (1, None, None), (2, "", "en"), (3, " \n\t", "en"), (4, "word", "en"), (None, "a null id here", "en"), (None, None, None),
        (5, "same row of text", "en"), (5, "same row of text", "en"), (6, "x" * 200_000, "fr"), (7, "é🙂 漢字 " * 3000, None), (5, "other text", "en"),
    ])


@pytest.fixture
def empty(edge):
    return edge.where(F.lit(False))
