import binascii

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import language_id as op

TEXTS = {
    "en": "The quick brown fox jumps over the lazy dog and then it sleeps in the sun for hours with the other animals",
    "de": "Der schnelle braune Fuchs springt über den faulen Hund und schläft dann stundenlang mit anderen in der Sonne",
    "fr": "Le rapide renard brun saute par-dessus le chien paresseux puis il dort au soleil pendant des heures entières",
}


def brute_grams(text):
    low = text.lower()
    letter = lambda i: 0 <= i < len(low) and low[i].isalpha()
    return [tuple(low[j] if letter(j) else " " for j in (i - 1, i, i + 1)) for i in range(len(low)) if letter(i)]


def test_grams_match_the_definition():
    texts = ["", "a", "Ab c", "1-2", "é ß-X", "  q  ", "İx", "x" * 5]
    grams, counts = op._grams(texts, op._letters())
    assert counts.tolist() == [len(brute_grams(t)) for t in texts]
    want = [sum(ord(c) << s for c, s in zip(g, (42, 21, 0))) for t in texts for g in brute_grams(t)]
    assert grams.tolist() == want


def test_filter_contains_every_gram_of_its_languages_and_corrects_for_others():
    rng = np.random.default_rng(1)
    grams = {k: rng.integers(0, 1 << 62, 3000).astype(np.uint64) for k in "abcdefghij"}
    made = op.GramFilter.build(sorted(grams), grams, slots=1 << 15)
    for bit, name in enumerate(sorted(grams)):
        assert np.all(np.unpackbits(made.masks(grams[name]), axis=1, bitorder="little")[:, bit] == 1)
    strange = np.unpackbits(made.masks(rng.integers(0, 1 << 62, 20_000).astype(np.uint64)), axis=1, bitorder="little")
    assert np.allclose(strange.mean(axis=0)[:10], made.false, atol=0.01)


def test_held_out_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = op.identify(docs).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 200 and sum(r.lang_pred == r.lang for r in got) / len(got) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert all(binascii.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got)


def test_nulls_ties_and_extra_columns(spark):
    rows = [(i, t, k) for n, (k, t) in enumerate(TEXTS.items()) for i in range(n * 30, n * 30 + 30)]
    rows += [(900, None, "en"), (901, "", None), (902, "12 34 !?", "de"), (903, TEXTS["fr"], None), (None, TEXTS["de"], "de"),
             (904, TEXTS["en"] * 3000, "en"), (904, TEXTS["en"] * 3000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumns({c: F.lit("x") for c in ("lang_pred", "score", "p", "gram", "n", "held_out")})
    got = {r.doc_id: r for r in op.identify(docs).collect()}
    assert op.identify(docs).count() == len(rows)
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None, 904)] == ["und", "und", "und", "fr", "de", "en"]
    assert [got[i].score for i in (900, 901, 902)] == [0, 0, 0]


@pytest.mark.parametrize("rows", [[], [(1, "some words", None)]])
def test_nothing_to_learn(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert [r.lang_pred for r in op.identify(docs).collect()] == ["und"] * len(rows)
