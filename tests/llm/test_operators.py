"""Each operator against a plain version, and on nulls, empty and long texts, repeats and empty tables."""

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airq.llm import bpe, language, linededup, nearest, neardup, orderhash, packing, secrets, sharding, toxicity
from airq.llm.common import WordHashes, fold

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


def test_bpe_equals_the_library(rows):
    coder, library = bpe.Bpe(public_tokenizers.path(bpe.VOCABULARY)), Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    rng = random.Random(3)
    letters = "aaabbb  \n\t'sdtrellvm01239éèあ漢🙂\x1c\x85٠½.,!?$-_"
    texts = [r["text"] for r in rows] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["", "a" * 3000, " " * 3000, "<|endoftext|>", "x<|endoftext|> y", "ab" * 2000]
    mine = coder.encode_texts(texts, bpe.Known())
    for text, ids, theirs in zip(texts, mine, library.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == theirs.ids
        assert coder.decode(ids.tolist()) == library.decode(theirs.ids, skip_special_tokens=False) == text


def test_bpe_query_and_edges(spark, rows, edge, empty):
    got = {r["doc_id"]: r for r in bpe.query(spark, SF).collect()}
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    for r in rows:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
    back = edge.select("text", bpe.decode(bpe.encode(F.col("text"))).alias("back")).collect()
    assert all((r["text"] or "") == r["back"] for r in back)
    assert empty.select(bpe.encode(F.col("text"))).count() == 0


def test_packing_query(spark, rows):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    ids = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids + [1] for r in rows}
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in packing.query(spark, SF).collect():
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(part) and r["doc_tokens"] == len(ids[r["doc_id"]])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for parts, total in [*((p, None) for p in sequences.values()), *((pieces[i], len(ids[i])) for i in ids)]:
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == total if total else at <= 2048
    assert sum(2048 * len(sequences) - n for n in [sum(map(len, ids.values()))]) < 0.03 * sum(map(len, ids.values()))


def test_packing_plan_uses_up_any_histogram():
    rng = np.random.default_rng(5)
    for lengths in (rng.integers(1, 2049, 3000), np.full(1000, 700), np.full(999, 2048), np.array([1]), rng.geometric(0.01, 5000).clip(1, 2048)):
        histogram = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True))))
        used = defaultdict(int)
        for pattern, n in packing.plan(histogram):
            assert n > 0 and sum(pattern) <= 2048
            for a in pattern:
                used[a] += n
        assert dict(used) == histogram


def test_packing_edges(edge, empty):
    got = packing.pack(edge).collect()
    assert sum(r["doc_id"] is None for r in got) == 2 and sum(r["doc_id"] == 5 for r in got) == 3
    assert packing.pack(empty).count() == 0


def test_fingerprint_by_hand(spark, rows):
    """The numbered k-mers, bins and order by a plain version on top of Spark's hash."""
    text = "a b c a b c a b d " * 4
    pieces = text.split()
    got = spark.createDataFrame([(text,)], "text string").select(orderhash.fingerprint("text").alias("p")).first()["p"]
    kmers = spark.createDataFrame([tuple(pieces[i : i + 3]) for i in range(len(pieces) - 2)], "a string, b string, c string")
    high = ~orderhash.LOW
    base = [r[0] & high for r in kmers.coalesce(1).select(F.xxhash64("a", "b", "c")).collect()]
    seen, numbered = defaultdict(int), []
    for i, h in enumerate(base):
        numbered.append((h >> 24, seen[h], i))
        seen[h] += 1
    hashed = spark.createDataFrame(numbered, "h long, n int, i long").coalesce(1).select(F.xxhash64("h", "n"), "i").collect()
    bins = defaultdict(list)
    for h, i in sorted(((h & high) | i, i) for h, i in hashed):
        bins[h >> orderhash.BIN_SHIFT].append((h >> 24, i))
    pairs = [(b, [h for h, _ in sorted(v[:2], key=lambda x: x[1])]) for b, v in sorted(bins.items())]
    want = []
    for b, hs in pairs:
        value = spark.range(1).select(F.xxhash64(*[F.lit(h).cast("long") for h in hs])).first()[0]
        want.append(((b + 16) << 27) | (value & ((1 << 27) - 1)))
    assert got == want


def test_fingerprint_query(spark, rows, edge, empty):
    got = {r["doc_id"]: r for r in orderhash.query(spark, SF).collect()}
    down = rows[::-1]
    for r, following in zip(down, down[1:] + down[:1]):
        n = len(r["text"])
        edited = r["text"][: n - n // 2] + following["text"][: n // 2]
        assert got[r["doc_id"]]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[r["doc_id"]]["n_chars"] == n
    prints = defaultdict(set)
    for r in rows:
        prints[r["text"]].add(got[r["doc_id"]]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    told = orderhash.fingerprints(edge).collect()
    assert len(told) == edge.count() and orderhash.fingerprints(empty).count() == 0
    assert all(r["print"] == [] for r in told if not r["text"].strip())


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[200:] + words[:200]), " ".join(f"v{i}" for i in range(400))]
    a, b, c = (r["p"] for r in spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).select(orderhash.fingerprint("text").alias("p")).collect())
    share = lambda x, y: len(set(x) & set(y)) / 32
    assert share(a, c) == 0 and 0.2 < share(a, b) < 0.85


def test_order_of_short_texts(spark):
    """At 30 words the order counts less than at 400, as the README says, but it counts."""
    rng, pairs = random.Random(2), []
    for _ in range(100):
        words = [f"w{rng.randrange(10**9)}" for _ in range(30)]
        pairs.append((" ".join(words), " ".join(words[15:] + words[:15])))
    prints = spark.createDataFrame(pairs, "x string, y string").coalesce(1).select(*[orderhash.fingerprint(c).alias(c) for c in "xy"])
    assert 0.55 < prints.select(F.avg(orderhash.likeness("x", "y"))).first()[0] < 0.75


def test_edits_inside_unspaced_text(spark):
    """A character put in or taken out leaves most of an unspaced run's k-mers as they are; other runs share none."""
    rng = random.Random(12)
    alphabets = ["".join(map(chr, range(0x4E00, 0x4E00 + 800))), "".join(map(chr, range(0x0E01, 0x0E2F))), "ABCDEFGHabcdefgh0123456789+/", "🙂🙃😀😁漢字かな"]
    pairs = []
    for letters in alphabets:
        run, other = ("".join(rng.choice(letters) for _ in range(1000)) for _ in range(2))
        for near in (rng.choice(letters) + run, run[1:], run[:300] + rng.choice(letters) + run[300:], "some words before " + run):
            pairs.append((run, near, other))
    pairs.append(("a" * 1000, "b" + "a" * 1000, "".join(rng.choice(alphabets[2]) for _ in range(1000))))
    pairs.append(("0123456789abcdef" * 60, "x" + "0123456789abcdef" * 60, "漢" * 500))
    table = spark.createDataFrame(pairs, "x string, y string, z string").coalesce(1).select(*[orderhash.fingerprint(c).alias(c) for c in "xyz"])
    told = table.select(orderhash.likeness("x", "y").alias("near"), orderhash.likeness("x", "z").alias("far")).collect()
    assert min(r["near"] for r in told) > 0.6 and max(r["far"] for r in told) < 0.1


def test_trigram_queries():
    for rule in secrets.RULES:
        query = secrets.required(rule.pattern)
        for text in ('password = "abcdefghijklm"', "API_KEY:0123456789abcd", "Token=xxxxxxxxxxxxxxxx", "AKIA" + "Z" * 16, "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "0" * 20):
            if re.search(rule.pattern, text):
                low = text.lower()
                assert any(all(t in low for t in alternative) for alternative in query)
    of = lambda *alternatives: frozenset(frozenset(a.split()) for a in alternatives)
    assert secrets.required("abc[de]f+") == of("abc bcd", "abc bce") and secrets.required("(?i:KEY)x?|[^a]z") == secrets.ANY
    assert secrets.required("(?:one|two)*+four") == of("fou our") and secrets.required(r"\x41\.B{2}[a-z]+(?:end|END)$") == of("a.b .bb end")
    assert secrets.required("ab{0,1}c{3}") == of("acc ccc", "abc bcc ccc") and secrets.required("[]x-]yz") == of("]yz", "xyz", "-yz")
    for unknown in (r"\dabc", "(?=abc)", "(abc", "[abc", "abc)"):
        with pytest.raises(ValueError):
            secrets.required(unknown)


def test_scan_without_ids_and_with_clashing_columns(spark):
    rows = spark.createDataFrame([(None, "k1 AKIA" + "C" * 16, 1, "x"), (None, None, 2, "y"), (None, "", 3, None)], "`row` string, text string, part int, `a.b` string")
    got = sorted(secrets.scan(rows).collect(), key=lambda r: r["part"])
    assert secrets.scan(rows).columns == [*rows.columns, "found"] and [len(r["found"]) for r in got] == [1, 0, 0] and [r["a.b"] for r in got] == ["x", "y", None]
    assert sorted(r["text"] or "" for r in secrets.redact(rows).collect()) == ["", "", "k1 [SECRET]"]


def test_secret_spans_and_masks(spark, docs, edge, empty):
    texts = ['é🙂 password = "abcdefghijklmnop" x', "token: secret:abcdefghijklmnop", "AKIA" + "B" * 16 + " deadbeefdeadbeef", 'token="' + "ab" * 20 + '"', "", None, "Secret=" + "a" * 11]
    table = docs([(i, t, "en") for i, t in enumerate(texts)])
    found = {r["doc_id"]: r["found"] for r in secrets.scan(table.select("doc_id", "text")).collect()}
    for i, text in enumerate(texts):
        want = sorted((m.start(), k, m.end()) for k, rule in enumerate(secrets.RULES) for m in re.finditer(rule.pattern, text or "") if len(m[rule.group]) >= rule.least)
        assert [tuple(x) for x in found[i]] == want
    masked = {r["doc_id"]: r for r in secrets.redact(table).collect()}
    assert masked[3]["text"] == "[SECRET]\"" and masked[0]["text"] == 'é🙂 [SECRET]" x' and masked[0]["n_chars"] == len(masked[0]["text"])
    assert masked[5]["text"] is None and secrets.redact(table).columns == table.columns
    assert secrets.redact(edge).count() == edge.count() and secrets.redact(empty).count() == 0


def test_private_keys_are_masked_whole(spark, docs):
    rng = random.Random(6)
    line = lambda n: "".join(rng.choice("ABCXYZabcxyz0189+/") for _ in range(n))
    body = "\n".join(line(64) for _ in range(25))
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    encrypted = f"Proc-Type: 4,ENCRYPTED\nDEK-Info: DES-EDE3-CBC,0123456789ABCDEF\n\n{body}\nab=="
    quoted = "\\n".join([begin, *body.split("\n"), line(9) + "==", end])
    far = begin + ("\n" + line(76)) * 1000
    many = "\n".join(f"A-{i}: x" for i in range(10))
    block = [f"-----{word} PGP PRIVATE KEY BLOCK-----" for word in ("BEGIN", "END")]
    armor = f"{block[0]}\nVersion: X v1.4.11 (Y/Z)\n\n{body}\n=aB3d"
    cases = [
        (f"é {begin}\n{body}\n{line(20)}=\n{end}\nnext", "é [SECRET]\nnext"), (f"{begin}\n{encrypted}\n{end} x", "[SECRET] x"),
        (f'k = "{quoted}"', 'k = "[SECRET]"'), (f"{begin}\r\n" + body.replace("\n", "\r\n") + f"\r\n{end}\r\n", "[SECRET]\r\n"),
        (f"a {begin}\n{body}\n{line(7)}", "a [SECRET]"), (f"{begin}\n{body}\n{line(6)}==\n\nplain words follow", "[SECRET]\n\nplain words follow"),
        (f"{begin}\n{body}\n\nplain words follow", "[SECRET]\n\nplain words follow"), (f"the line {begin} starts a key", "the line [SECRET] starts a key"),
        (f"{begin}\n{body}\n{begin}\n{body}\n{end}", "[SECRET]\n[SECRET]"), (f"{far}\n\nplain words", "[SECRET]\n\nplain words"),
        (f"{begin}\n{many}\n\n{body}\n{end} x", "[SECRET] x"), (f"{begin}\n{many}\n\n{body}\nplain words", "[SECRET]\nplain words"),
        (f"{armor}\n{block[1]}\nx", "[SECRET]\nx"), (f"{begin}\n" + f"a-b {line(40)} -- c\n" * 5000 + f"{end}.", "[SECRET]."),
        (begin + "\n" + line(64) * 20_000 + " z", "[SECRET] z"), (f"{begin}\n" + "plain words " * 50_000, "[SECRET]\n" + "plain words " * 50_000),
    ]
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(docs([(i, t, "en") for i, (t, _) in enumerate(cases)])).collect()}
    assert [masked[i] for i in range(len(cases))] == [m for _, m in cases]
    assert secrets.required(secrets.PEM) == secrets.required(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----")


def test_toxicity_folds_and_scores(spark, edge, empty):
    lexicon = toxicity.Lexicon({"idiot": 4.0, "ioser": 4.0, "vequ*": 3.0}, ("ioser tree",), (-4.0, 1.5, 0.5))
    scorer = toxicity.Scorer(lexicon)
    assert [scorer.features(t)[0] for t in ("an 1d10t!", "іdіоt", "ＩＤＩＯＴ", "ídiöt", "!diot", "idiots", "a loser tree", "a loser", "Vequerie", "", None)] == [4, 4, 4, 4, 4, 0, 0, 4, 3, 0, 0]
    assert scorer.score(8, 20) > scorer.score(4, 20) > scorer.score(4, 2000) > 0
    told = toxicity.score(edge, lexicon)
    assert all(r["score"] == 0 for r in told.collect()) and toxicity.score(empty, lexicon).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(edge, labels, fold("doc_id", 4) == 2).weights == {}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in toxicity.query(spark, sf).where("held_out").collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in got]
    hit = sum(got[r["doc_id"]]["predicted"] for r in labels if r["toxic"])
    wrong = sum(got[r["doc_id"]]["predicted"] for r in labels if not r["toxic"])
    toxic = sum(r["toxic"] for r in labels)
    assert hit >= 0.9 * toxic and wrong <= 0.02 * (len(labels) - toxic)


def test_language_held_out(spark, edge, empty):
    told = language.query(spark, "/root/testdata/sf0.01").where("held_out").collect()
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sum(r["lang_pred"] == true[r["doc_id"]] for r in told) >= 0.98 * len(told)
    model = language.fit(edge, F.lit(False))
    assert model.langs == ["en", "fr"]
    pred = {(r["doc_id"], r["text"] and r["text"][:4]): r["lang_pred"] for r in language.predict(edge, model).collect()}
    assert pred[1, None] == pred[2, ""] == pred[3, " \n\t"] == "und" and pred[6, "xxxx"] == "fr"
    assert language.predict(empty, language.fit(empty, F.lit(False))).count() == 0
    assert language.keep_known(edge).columns == edge.columns


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = [np.unique(base), np.unique(np.concatenate((base[:320], rng.integers(0, 1 << 62, 20).astype(np.uint64)))), base[:1]]
    sketch = neardup.sketches(np.concatenate(sets), np.array([len(s) for s in sets]), 160)
    assert (sketch != neardup._EMPTY).all()
    true = len(np.intersect1d(sets[0], sets[1])) / len(np.union1d(sets[0], sets[1]))
    assert abs((sketch[0] == sketch[1]).mean() - true) < 0.15


def test_near_duplicates_by_brute_force(spark, docs, edge, empty):
    rng = random.Random(9)
    word = lambda: f"w{rng.randint(0, 50)}"
    rows = []
    for _ in range(12):
        text = [word() for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 8)):
            copy = list(text)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy), "en"))
    table = docs(rows)
    sets = {i: shingles(t, 5) for i, t, _ in rows}
    home = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    home[a] = home[b] = min(home[a], home[b])
    got = {r["doc_id"]: r["component_id"] for r in neardup.groups(table.select("doc_id", "text")).collect()}
    assert got == home
    kept = neardup.keep_first(table)
    assert {r["doc_id"] for r in kept.collect()} == set(home.values()) and kept.columns == table.columns
    assert neardup.groups(empty).count() == 0
    counts = defaultdict(int)
    for r in neardup.keep_first(edge).collect():
        counts[r["doc_id"], r["text"]] += 1
    assert counts[5, "same row of text"] == 1 and counts[1, None] == 1 and counts[2, ""] == 1


def test_repeated_passages_by_brute_force(docs, edge, empty):
    rng = random.Random(4)
    words = lambda n: [f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(n)]
    passage, other = words(70), words(55)
    texts = [words(30) + passage + words(20), words(5) + passage, passage[:40] + words(60), words(90), other + words(10) + other, words(200) + passage[5:] + other + words(3)]
    rows = [(i, " ".join(t) if i % 2 else " ".join(t).replace(" ", "\n", 9), "en") for i, t in enumerate(texts)]
    cut = {r["doc_id"]: r for r in linededup.removals(docs(rows)).collect()}
    left = {i: t if i not in cut else "".join(t[a:b] for a, b in zip([0, *[s["end"] for s in cut[i]["spans"]]], [*[s["start"] for s in cut[i]["spans"]], len(t)])) for i, t, _ in rows}
    assert set(cut) == {1, 4, 5}
    assert left[1].split() == texts[1][:5] and left[4].split() == texts[4][:65] and left[5].split() == texts[5][:200] + texts[5][-3:]
    kept = linededup.keep_new(docs(rows))
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == left and kept.columns == docs(rows).columns
    assert linededup.removals(empty).count() == 0
    assert linededup.keep_new(edge).count() == edge.count()


def test_repeats_whose_first_holders_have_parts(docs):
    """Every 50 words that stand earlier are cut, whichever places hold a part of them before; three places within one text too."""
    rng = random.Random(8)
    words = lambda n: [f"{rng.choice('abcdefgh')}{rng.randint(0, 40000)}" for _ in range(n)]
    texts = []
    for _ in range(20):
        p = words(60)
        texts += [words(9) + p[:49] + words(9), words(7) + p[11:] + words(9), words(5) + p + words(6), words(8) + p + words(3)]
        q = words(60)
        texts += [words(4) + q[:49] + words(5) + q[11:] + words(6) + q + words(7) + q + words(2), words(70), words(3) + q[4:58]]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        cut = set()
        for a in range(len(t) - 49):
            window = tuple(t[a : a + 50])
            cut |= set(range(a, a + 50)) if window in seen else set()
            seen.add(window)
        want[i] = [w for k, w in enumerate(t) if k not in cut]
    got = {r["doc_id"]: r["text"].split() for r in linededup.keep_new(docs([(i, "é " + " ".join(t), "en") for i, t in enumerate(texts)])).collect()}
    assert got == {i: ["é", *t] for i, t in want.items()}


def test_nearest_recall(spark):
    got = defaultdict(list)
    for r in nearest.query(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    found = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        found, total = found + len(set(best) & {v for v, _ in got[ids[i]]}), total + 20
        assert len(got[ids[i]]) == 20
    assert found >= 0.95 * total


def test_nearest_prunes_by_ratio():
    """Clustered vectors: recall within the lists read, share of all rows read, and no count that bounds the lists."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 24))[rng.integers(0, 400, 30_000)] + 0.25 * rng.normal(size=(30_000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    lists = nearest.fitted(nearest.build(x[:20_000], 1.0), x[:20_000], 20)
    assert len(lists.centroids) >= 300
    member, read = np.zeros((len(x), len(lists.centroids)), bool), np.zeros((300, len(lists.centroids)), bool)
    for a in range(0, len(x), 5000):
        row, number = nearest.lists_of(lists, x[a : a + 5000], False)
        member[a + row, number] = True
    read[nearest.lists_of(lists, x[-300:], True)] = True
    assert member.any(1).all() and 1 < member.sum() / len(x) <= 1.2 * nearest.COPIES
    top = np.argsort(-(x[-300:] @ x.T), 1, kind="stable")[:, 1:21]
    recall = np.mean([(member[top[i]] & read[i]).any(1).mean() for i in range(300)])
    assert recall >= 0.9 and (read @ member.sum(0)).mean() / len(x) < 0.1
    flat = rng.normal(size=(3000, 24))
    wide = nearest.replace(nearest.build(flat, (flat**2).sum(1).max(), 16), read=10.0)
    row, number = nearest.lists_of(wide, flat[:50], True)
    assert len(wide.centroids) > wide.beam and len(set(zip(row, number))) == len(row) == 50 * len(wide.centroids)


def test_nearest_block_is_brute_force():
    rng = np.random.default_rng(9)
    table = lambda n, base: pd.DataFrame({"vec_id": base + np.arange(n), "v": list(rng.integers(-2, 3, (n, 4)).astype(float)), "lists": [np.sort(rng.choice(16, rng.integers(1, 5), False)) for _ in range(n)]})
    vs, qs = table(700, 0), table(90, 5000)
    got = nearest.best_of_block(vs, qs, 7).groupby("query_id")[["vec_id", "score"]].apply(lambda g: [tuple(r) for r in g.to_numpy()]).to_dict()
    for r in qs.itertuples():
        near = sorted((-float(r.v @ v.v), v.vec_id) for v in vs.itertuples() if set(v.lists) & set(r.lists))
        assert got[r.vec_id] == [(i, -s) for s, i in near[:7]]


def test_nearest_edges(spark):
    rows = [(20, [1.0, 0.0]), (40, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (60, [None, 1.0]), (6, [0.5, 0.5]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in nearest.search(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 1), (20, 2, 40), (20, 3, 6), (20, 4, 2), (40, 1, 1), (40, 2, 20), (40, 3, 6), (40, 4, 2)]
    assert nearest.search(table.where("vec_id > 99"), F.lit(True)).count() == 0


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = sharding.curve_index(cells, bits)
        assert sorted(index.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards(spark, rows, edge, empty):
    got = sharding.query(spark, SF).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(got) == len(rows) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    text = {r["doc_id"]: r["text"].encode() for r in rows}
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in got)
    assert sorted(r["size"] for r in sharding.shards(edge).collect())[:3] == [1, 1, 1] and sharding.shards(empty).count() == 0


def test_few_values_and_like_texts_spread_over_the_cells(spark, monkeypatch):
    seen = []
    index = sharding.cells_of
    monkeypatch.setattr(sharding, "cells_of", lambda df, column, bits: seen.append(index(df, column, bits)) or seen[-1])
    rows = [(i, ["de", "en", "fr", "zh"][i % 4], None if i == 7 else "" if i == 8 else f"https://site/{i % 40:02}", "p" * (i % 5)) for i in range(400)]
    table = spark.createDataFrame(rows, "id long, lang string, source string, pad string")
    got = sharding.curved(table.withColumn("size", F.length("pad")), ["lang", "source", "size"]).select("lang", "source", "size", "curve", *[c.alias(f"c{k}") for k, c in enumerate(seen)]).collect()
    cells = {r["lang"]: r["c0"] for r in got}
    assert [cells[x] for x in ("de", "en", "fr", "zh")] == [16, 32, 48, 63]
    source = {r["source"]: r["c1"] for r in got}
    assert source.pop(None) is None and source.pop("") == 0
    ordered = [source[x] for x in sorted(source)]
    assert len(set(ordered)) == 40 and ordered == sorted(ordered) and ordered[-1] == 63
    # Eight runs of the curve tell the languages apart.
    shards = defaultdict(set)
    for place, r in enumerate(sorted(got, key=lambda r: r["curve"])):
        shards[place * 8 // len(got)].add(r["lang"])
    assert sum(map(len, shards.values())) <= 20


def test_word_hashes_are_remembered():
    known = WordHashes()
    assert known.of([b"a", b"b", b"a"]).tolist()[0] == known.of([b"a"]).tolist()[0] and json.dumps(list(map(len, known))) == "[1, 1]"
