import binascii
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskspark.llm import lm_score as op


def tokens(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute(pairs, word_share, gram_share, d=op.DISCOUNT):
    out = lambda k: binascii.crc32(("" if k is None else str(k)).encode()) % 10 == 0
    train = [tokens(t) for k, t in pairs if not out(k)]
    one = Counter(w for t in train for w in t)
    n, v = sum(one.values()), len(one)
    head = {w for w, c in one.items() if c >= word_share * n}
    least = max(2, math.ceil(gram_share * n))
    grams = lambda k: {g: c for g, c in Counter(tuple(t[i:i + k]) for t in train for i in range(len(t) - k + 1)).items()
                       if c >= least and set(g) <= head}
    two, three = grams(2), grams(3)

    def p1(w):
        return (one[w] + 0.1) / (n + 0.1 * (v + 1))

    def p2(a, w):
        if (a, w) in two:
            return (two[a, w] - d) / one[a]
        kept = [g for g in two if g[0] == a]
        rest = (1 - sum((two[g] - d) / one[a] for g in kept)) / (1 - sum(p1(g[1]) for g in kept))
        return rest * p1(w)

    def p3(a, b, w):
        if (a, b, w) in three:
            return (three[a, b, w] - d) / two[a, b]
        kept = [g for g in three if g[:2] == (a, b)]
        if not kept:
            return p2(b, w)
        rest = (1 - sum((three[g] - d) / two[a, b] for g in kept)) / (1 - sum(p2(b, g[2]) for g in kept))
        return rest * p2(b, w)

    rows = []
    for k, text in pairs:
        t = tokens(text)
        model = sum(math.log10(p3(t[i - 2], t[i - 1], w) if i > 1 else p2(t[0], w) if i else p1(w)) for i, w in enumerate(t))
        rows.append((k, out(k), len(t), sum(one[w] > 0 for w in t), n, sum(math.log10(p1(w)) for w in t), model))
    return rows


def texts():
    rng = random.Random(4)
    common = "the of and to in is that it was for".split()
    made = []
    for _ in range(120):
        words = [rng.choice(common) if rng.random() < 0.7 else f"W{rng.randrange(200)}é" for _ in range(rng.randint(0, 60))]
        made.append("\t".join(words[:10]) + " " + " ".join(words[10:]) + rng.choice(["", " one two three four", "\n"]))
    return [*made, None, "", "unseen words only", "THE of THE of " * 500]


@pytest.mark.parametrize("word_share,gram_share", [(2.0**-20, 2.0**-18), (0.005, 0.002), (0.02, 0.5)])
def test_against_brute_force(spark, docs_of, word_share, gram_share):
    pairs = list(enumerate(texts())) + [(None, "the of the"), (7, "the end"), (7, "the end")]
    docs = docs_of(pairs).withColumns({c: F.lit("x") for c in ("row", "words", "word", "n", "t", "score")})
    got = sorted((tuple(r) for r in op.score(docs, word_share=word_share, gram_share=gram_share).collect()), key=repr)
    want = sorted(brute(pairs, word_share, gram_share), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    base, model = op.score(docs).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert model > base


def test_without_training_rows(spark, docs_of):
    assert op.score(docs_of([])).count() == 0
    key = next(k for k in range(100) if binascii.crc32(str(k).encode()) % 10 == 0)
    row = op.score(docs_of([(key, "a b")])).first()
    assert tuple(row)[1:] == (True, 3, 0, 0, 0.0, 0.0)


def test_ngrams_that_occur_twice_are_kept_at_every_size(spark, docs_of):
    # So many tokens that a share of 2**-18 would ask for four occurrences.
    keys = [k for k in range(100) if binascii.crc32(str(k).encode()) % 10][:3]
    pairs = [(keys[0], "rare pair here"), (keys[1], "rare pair here"), (keys[2], "filler " * 900_000)]
    got = {r.doc_id: r for r in op.score(docs_of(pairs)).collect()}
    n = got[keys[0]].train_tokens
    first = math.log10(2.1 / (n + 0.1 * 6))
    assert n == 900_009 and got[keys[0]].score == pytest.approx(first + 3 * math.log10(1.25 / 2), rel=1e-9)


def test_chunks_and_buckets_change_no_result(spark, docs_of):
    pairs = list(enumerate(texts())) + [(None, "the of the"), (7, "the end"), (7, "the end")]
    got = sorted((tuple(r) for r in op.score(docs_of(pairs), chunk=300, bucket=200).collect()), key=repr)
    want = sorted(brute(pairs, 0, 0), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_written_arcs_and_states(spark, docs_of):
    pairs = list(enumerate(texts()))
    made = op.learn(docs_of(pairs), chunk=500, bucket=150)
    arcs = made.arcs().collect()
    train = [tokens(t) for k, t in pairs if binascii.crc32(str(k).encode()) % 10]
    for size, least in ((1, 1), (2, 2), (3, 2)):
        want = Counter(tuple(t[i:i + size]) for t in train for i in range(len(t) - size + 1))
        mine = [a for a in arcs if a["size"] == size]
        assert sorted(a.n for a in mine) == sorted(n for n in want.values() if n >= least)
        assert len({a.number for a in mine}) == len(mine)
    # An arc's history is an arc of the shorter kind, and the states are the histories that have arcs.
    for size in (2, 3):
        histories = {a.first for a in arcs if a["size"] == size}
        assert histories <= {a.number for a in arcs if a["size"] == size - 1}
        assert histories == {r.number for r in made.states.collect() if r["size"] == size - 1}


def test_root_arcs_take_no_room_in_the_dictionary():
    """A chunk of which no n-gram is kept: all arcs are the root's, which are found by their words."""
    import numpy as np
    import pyarrow as pa

    words, code = op.tokenized(b"a b c\xffa c\xff")
    lens = np.diff(np.flatnonzero(code == words.index(b"\xff")), prepend=-1)
    row = {"chunk": 0, "codes": op._pack(code), "lens": op._pack(lens), "words": op._joined(words), "held": [False, False]}
    sent = pa.Table.from_batches(list(op._sent_words(iter(pa.Table.from_pylist([row]).to_batches()), 1)))
    back = op._numbered_words(sent).slice(1)
    chunk = op.Words(code, lens, np.zeros(2, bool))
    automaton = op.Automaton(chunk, back, 1, 2.0, 7 + 0.1 * 5, 0.75)
    assert not automaton.arcs and automaton.weight.itemsize == 8
    want = sum(math.log10((n + 0.1) / 7.5) for n in (2, 1, 2, 2))
    assert automaton.score(code[:4].tolist()) == pytest.approx(want)


@pytest.mark.parametrize("side_by_side", [1, 3, 10**9])
def test_texts_are_traversed_side_by_side_or_one_by_one(spark, docs_of, monkeypatch, side_by_side):
    import numpy as np
    import pyarrow as pa

    pairs = list(enumerate(texts()))
    made = op.learn(docs_of(pairs).coalesce(1))
    chunk = made.chunks.toArrow()
    states = made.states.toArrow()
    known = pa.concat_tables([t.where("to_chunk >= 0").toArrow() for t in (made.one, made.two, made.three)])
    asked = known.select(["size", "bucket", "to_chunk", "place"]).rename_columns(["size", "bucket", "chunk", "place"])
    priced = [op._priced(asked.filter(pa.compute.equal(asked["size"], k)), states.filter(pa.compute.equal(states["size"], k)), made.buckets)
              for k in (1, 2)]
    assert len(chunk) == made.buckets == 1
    monkeypatch.setattr(op, "SIDE_BY_SIDE", side_by_side)
    _, words = op._read(chunk)
    automaton = op.Automaton(words, pa.concat_tables([known, *priced]), 1, made.fewest, made.size, op.DISCOUNT)
    got = automaton.scores(words.lens)
    want = {k: w for k, *_, w in brute(pairs, 0, 0)}
    assert np.allclose(got, [want[k] for k in chunk["keys"][0].as_py()], rtol=1e-9)
