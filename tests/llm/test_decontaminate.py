import hashlib
import random
import re

from pyspark.sql import functions as F

from riskspark.llm import decontaminate as op


def words(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    strings = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            strings.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in range(1, 11):
                if (s := tuple(w[i:i + n])) in strings and len(s) == n:
                    hit |= set(range(i, i + n))
                    found |= strings[s] - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(3)
    text = lambda n, a="abc": " ".join(rng.choice(a) for _ in range(n))
    items = [(1, text(12)), (2, text(30)), (10, "One, two"), (11, "SOLO!"), (12, None), (13, "..."), (14, text(10)),
             (14, text(10)), (None, "x y z"), (15, "é ß x"), (16, text(9, "pq"))]
    docs = [text(rng.randint(0, 400)) for _ in range(40)]
    docs += [text(3) + " " + items[1][1].upper() + "-" + text(2), "one-TWO solo", "é SS x", "é ß X", None, "", "?",
             text(9, "pq") + " " + items[-1][1], "x y z y z", " ".join([items[0][1]] * 500)]
    return list(enumerate(docs)), items


def test_against_brute_force_in_one_block_and_in_several(spark, docs_of):
    docs, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    table = docs_of(docs).withColumns({c: F.lit(9) for c in ("n_words", "hit", "items", "f", "a")})
    want = brute(docs, items)
    assert sorted((tuple(r) for r in op.scan(table, benchmark).collect()), key=repr) == want
    assert sorted((tuple(r) for r in op.scan(table, benchmark, strings=7).collect()), key=repr) == want


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in op.scan(docs_of(["a b", "a b"]), none).collect()] == [False, False]
    assert op.scan(docs_of([]), none).count() == 0


def test_shift_table_skips_and_finds_overlaps():
    search = op.Search({tuple(b"a b a b".split()): ["1"], tuple(b"b a b".split()): ["2"]})
    hit, items = search.find(b"x a b a b a b y b a".split())
    assert hit == set(range(1, 7)) and items == {"1", "2"}


def test_repeated_rows_and_null_ids_keep_their_rows_in_several_blocks(spark, docs_of):
    docs, items = cases()
    docs = [*docs, *docs[:45], *((None, text) for _, text in docs), (None, None), (0, "SOLO"), (0, "clean text")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for strings in (7, op.STRINGS):
        assert sorted((tuple(r) for r in op.scan(docs_of(docs), benchmark, strings=strings).collect()), key=repr) == want
