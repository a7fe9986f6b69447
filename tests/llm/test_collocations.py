"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskspark.llm import collocations as op

FIELDS = "doc_id long, text string, lang string"


def plain(rows, support=10, covered=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, count in f.items():
        found = []
        for phrase, a in count.items():
            if len(phrase) < 2 or a < support:
                continue
            score, k = min((10**6 * a * a // (count[phrase[:k]] * count[phrase[k:]]), k) for k in range(1, len(phrase)))
            longer = [b for p, b in count.items() if len(p) == 3 > len(phrase) and b >= support and phrase in (p[:2], p[1:])]
            if not any(100 * b >= covered * a for b in longer):
                found.append((-score, -a, " ".join(phrase).encode(), count[phrase[:k]], count[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made_up(seed, docs=120, words=14):
    rng = random.Random(seed)
    vocab = ["The", "quick", "Ünï", "fox", "of", "and", "New", "York", "City", "a\x1c", "日本", "x-y", "ÿ", "\x00", "to"][:words + 1]
    gap = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "; ", "!", "\x0b"]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(vocab) + rng.choice(gap) for _ in range(rng.randrange(60)))
        rows.append((rng.choice([text, text + "new york city"]), rng.choice(["en", "de", None, "und"])))
    return [*rows, (None, "en"), ("", None), (" \t\n", "de"), ("one", "fr"), ("alone alone " * 2000, "es")]


@pytest.mark.parametrize("seed,shards,chunk,bucket,support", [
    (1, 4, 1, 50, 10), (2, 1, 300, 7, 3), (3, 40, 2000, 10**6, 10), (4, 4, op.CHUNK_BYTES, op.BUCKET_WORDS, 2)])
def test_against_plain(spark, seed, shards, chunk, bucket, support):
    rows = made_up(seed)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], FIELDS).repartition(3)
    got = op.mine(docs, support=support, shards=shards, chunk_bytes=chunk, bucket_words=bucket)
    assert sorted(map(tuple, got.collect())) == plain(rows, support)


def test_top_and_ties(spark):
    rows = [("b a. a b. c d. d c. zz zz", "en")] * 12
    got = op.mine(spark.createDataFrame([(1, *r) for r in rows], FIELDS), top=3)
    assert sorted(map(tuple, got.collect())) == plain(rows, top=3)


def test_large_counts_are_exact(spark):
    big = spark.range(1).selectExpr("10000000000001L a", "99999999999989L l", "99999999999971L r")
    from pyspark.sql import functions as F

    got = big.select(op._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first().s
    assert got == 10**6 * 10000000000001**2 // (99999999999989 * 99999999999971)


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([], FIELDS + ", size int, f int")
    assert op.mine(docs).count() == 0
    rows = [("so it goes on", "en")] * 10
    clash = spark.createDataFrame([(1, *r, 5, 6, "x") for r in rows], FIELDS + ", size int, f int, phrase string")
    assert sorted(map(tuple, op.mine(clash).collect())) == plain(rows)


def test_candidates_of_shards_are_complete(spark):
    rows = made_up(9)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], FIELDS).repartition(5)
    counts, sizes = op.frequent_phrases(docs, support=4, shards=3, chunk_bytes=200, bucket_words=100)
    want = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang or "und", s, " ".join(words[i:i + s]).encode()) for s in (1, 2, 3) for i in range(len(words) - s + 1))
    assert {(r.lang, r["size"], bytes(r.phrase)): r.f for r in counts.collect()} == {k: n for k, n in want.items() if n >= 4}
    assert {r.lang: r.n for r in sizes.collect()}["und"] == sum(n for (x, s, _), n in want.items() if x == "und" and s == 1)


def test_words_of_a_chunk():
    words = op.Words([b"A b\xffB.c", b"b"], ["de", "en"])
    assert [words.word[i] for i in words.ids] == [b"a", b"b", b"", b"b", b"", b"c", b"", b"b", b""]
    assert words.count().tolist() == [4, 1]
    assert np.array_equal(op.Words([], []).ids, [])
