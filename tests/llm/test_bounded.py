"""Long texts in parts, n-grams that depend on their own text alone, samples of any number of rows."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airq.llm import bpe, language
from airq.llm.common import hash_share, mix


def plain_grams(text):
    """Hash counts of the n-grams of one text, letter by letter."""
    padded = " "
    for c in text.lower():
        if c.isalpha() or padded[-1] != " ":
            padded += c if c.isalpha() else " "
    padded += "" if padded[-1] == " " else " "
    out = Counter()
    for n in language.GRAMS:
        for i in range(len(padded) - n + 1):
            if padded[i + 1] != " ":
                h = n
                for c in padded[i : i + n]:
                    h = (h * 0x9E3779B97F4A7C15 + ord(c)) % (1 << 64)
                out[int(mix(np.array([h], np.uint64))[0])] += 1
    return out


def texts():
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcde  \n.1éÉ漢ß") for _ in range(n))
    return [make(30), "", None, " ", "a", "ab", "1a2", make(200), "x" * 90, " lead", "trail ", make(500)]


@pytest.mark.parametrize("chars", [10, 60, 100_000])
def test_grams_depend_on_their_own_text_alone(monkeypatch, chars):
    monkeypatch.setattr(language, "CHARS", chars)
    found = Counter()
    for grams, owner in language.grams_of(texts(), language.letters()):
        found.update(zip(owner.tolist(), grams.tolist()))
    assert found == Counter({(i, h): n for i, t in enumerate(texts()) for h, n in plain_grams(t or "").items()})


def plain_language(model, text):
    counts, total = np.zeros(len(model.langs)), 0
    for h, n in plain_grams(text).items():
        slots = [(h >> (21 * j)) & (model.masks.shape[1] - 1) for j in range(language.PROBES)]
        total += n
        for i in range(len(model.langs)):
            counts[i] += n * all((int(model.masks[i // language.BITS][s]) >> (i % language.BITS)) & 1 for s in slots)
    left = np.maximum(0, (counts - total * model.chance) / (1 - model.chance))
    best = int(np.argmax(left))
    share = left[best] / total if total else 0.0
    return model.langs[best if share > 0 else model.common], min(1.0, share)


def test_language_equals_the_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs, F.lit(False), per_language=20, slots=1 << 12)
    rows = [r for r in docs.collect() if r["doc_id"] % 4 == 0]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    for r in rows:
        if r["text"] and any(map(str.isalpha, r["text"])):
            name, score = plain_language(model, r["text"])
            assert got[r["doc_id"]][0] == name and abs(got[r["doc_id"]][1] - score) < 1e-9


def test_one_long_text_takes_little_memory():
    text = "some words to be read, Andere Wörter auch. " * 60_000  # 2.6 million characters
    is_letter = language.letters()
    model = language.LanguageFilter(["x"], np.ones((1, 1 << 12), np.int64), np.zeros(1), 0)
    counts = np.zeros((1, 2))
    tracemalloc.start()
    for grams, owner in language.grams_of([text], is_letter):
        language.hits(model, grams, owner, counts)
    assert tracemalloc.get_traced_memory()[1] < 60_000_000
    tracemalloc.stop()
    assert counts[0, 1] == sum(plain_grams("some words to be read, Andere Wörter auch. " * 2).values()) - sum(plain_grams("some words to be read, Andere Wörter auch. ").values()) + (
        59_999 - 1) * (sum(plain_grams("some words to be read, Andere Wörter auch. " * 3).values()) - sum(plain_grams("some words to be read, Andere Wörter auch. " * 2).values())) + sum(
        plain_grams("some words to be read, Andere Wörter auch. ").values())


def test_long_texts_and_digests(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 200)
    monkeypatch.setattr(bpe, "STRETCH", 7)
    path = public_tokenizers.path(bpe.VOCABULARY)
    coder, library, known = bpe.Bpe(path), Tokenizer.from_file(path), bpe.Known()
    rng = random.Random(8)
    for n in (0, 1, 49, 51, 400, 3000):
        text = "".join(rng.choice("abc déf 漢🙂  \n12'll") for _ in range(n)) + "<|endoftext|> x" * (n % 2)
        ids = coder.encode_texts([text], known)[0]
        theirs = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == theirs
        import hashlib

        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert bpe.digests(ids, coder) == (sha(",".join(map(str, theirs))), sha(library.decode(theirs, skip_special_tokens=False)))


def test_samples_of_very_many_rows(spark):
    rows = spark.range(50_000)
    assert rows.where(hash_share(2000, F.lit(10**12), "id")).count() == 0
    assert rows.where(hash_share(2000, F.lit(10**12) * 0 + 50_000, "id")).count() in range(1800, 2200)
    assert rows.where(hash_share(50_000, F.lit(100), "id")).count() == 50_000


def test_bpe_plan_has_one_python_process(spark, edge, empty):
    plan = bpe.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    assert bpe.coded_digests(edge).count() == edge.count() and bpe.coded_digests(empty).count() == 0
