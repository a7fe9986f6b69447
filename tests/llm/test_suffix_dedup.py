import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskspark.llm import suffix_dedup as op


def brute(pairs, least=100):
    """pairs of id and text."""
    first = {}
    order = lambda k, i: (k is None, k or 0, i)
    bodies = [(k, (t or "").encode()) for k, t in pairs]
    for k, b in bodies:
        for i in range(len(b) - least + 1):
            w = b[i:i + least]
            first[w] = min(first.get(w, order(k, i)), order(k, i))
    out = []
    for k, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if first[b[i:i + least]] < order(k, i):
                gone[i:i + least] = b"\1" * least
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((k, len(b), len(b) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def cases():
    rng = random.Random(6)
    word = lambda n=4: "".join(rng.choice("abcdé ") for _ in range(n))
    passage = [word(rng.randint(20, 90)) * rng.choice([1, 1, 2]) + word(60) for _ in range(8)]
    texts = ["".join(rng.choice([rng.choice(passage), word(rng.randint(0, 150))]) for _ in range(rng.randint(0, 9)))
             for _ in range(60)]
    texts += ["x" * 400, "x" * 99, "x" * 100, "xy" * 300, texts[3], texts[3], texts[4] + "!", None, "", "short", "Aich " * 60]
    shared = word(130)
    texts += [word(50) + shared + word(50) for _ in range(40)] + [word(50) + shared[:101] for _ in range(10)]
    texts.append(word(30_000) + shared + word(30_000))
    return list(enumerate(texts))


@pytest.mark.parametrize("group,bucket_bytes", [(2000, 8 << 20), (3, 1000), (1, 8 << 20)])
def test_against_brute_force(spark, docs_of, group, bucket_bytes):
    pairs = cases() + [(None, "n" * 150 + "x" * 120), (-5, "x" * 101)]
    docs = docs_of(pairs).withColumns({c: F.lit("x") for c in ("id", "mark", "bucket", "kind", "a", "n_bytes", "kept")})
    assert answer(op.remove_repeats(docs, group=group, bucket_bytes=bucket_bytes, kept=False)) == brute(pairs)


def test_long_texts_are_cut_into_pieces_and_tasks_send_in_parts(spark, docs_of, monkeypatch):
    monkeypatch.setattr(op, "_PIECE", 700)
    monkeypatch.setattr(op, "_HELD", 50)
    monkeypatch.setattr(op, "_ARRAY", 500)
    pairs = cases()
    frames = []
    task = op._Task(4, 100)
    import numpy as np

    ids = np.array([k for k, _ in pairs])
    texts = [(t or "").encode() for _, t in pairs]
    frames = [*task.add(ids, ids * 0, texts), task.send()]
    # every run of 100 bytes holds an anchor: each text's contexts cover it
    assert len(frames) > 2
    assert answer(op.remove_repeats(docs_of(pairs), kept=False)) == brute(pairs)


def test_repeated_rows_are_one_document_and_ids_may_have_two_texts(spark, docs_of):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef") for _ in range(300))
    pairs = [(1, text), (1, text), (2, text[100:250]), (2, "other" * 30), (3, "z" + text)]
    got = answer(op.remove_repeats(docs_of(pairs), kept=False))
    assert [(g[0], g[2]) for g in got] == [(1, 0), (1, 0), (2, 145), (2, 150), (3, 300)]
    assert got == brute(pairs)


def test_documents_of_the_smallest_set(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = op.remove_repeats(docs)
    assert answer(got.drop("kept")) == want
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got.collect())


def test_suffix_arrays_and_maximal_repeats():
    rng = random.Random(8)
    for _ in range(60):
        texts = [bytes(rng.choice(b"\0b") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 5))]
        least = rng.randint(2, 6)
        array = op.SuffixArray(texts, least)
        suffixes = [(t[i:], n, i) for n, t in enumerate(texts) for i in range(len(t) - least + 1)]
        own = [texts[o][p - b:] for o, p, b in zip(array.owner[array.places], array.places, array.begin[array.places])]
        assert sorted(own) == sorted(s[0] for s in suffixes)
        for a, b, n in zip(own, own[1:], array.common[1:].tolist()):
            same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert n == same
        want = set()
        for s, _, _ in suffixes:
            for n in range(least, len(s) + 1):
                at = [(m, i) for m, t in enumerate(texts) for i in range(len(t) - n + 1) if t[i:i + n] == s[:n]]
                after = {texts[m][i + n:i + n + 1] or (m, "end") for m, i in at}
                before = {texts[m][i - 1:i] if i else (m, "start") for m, i in at}
                if len(at) > 1 and len(after) > 1 and (len(before) > 1):
                    want.add((n, tuple(sorted(at))))
        got = set()
        for n, a, b in op.maximal_repeats(array, least):
            places = array.places[a:b]
            got.add((n, tuple(sorted(zip(array.owner[places].tolist(), (places - array.begin[places]).tolist())))))
        assert got == want


def test_empty_table(docs_of):
    assert op.remove_repeats(docs_of([])).count() == 0
