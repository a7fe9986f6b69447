import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskspark.llm import simhash as op


def brute_print(text, k=4):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(shingles))


def brute_components(prints, radius=4):
    """prints: (id, number) pairs; the smallest id reachable for each."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(prints))]


def test_fingerprints_match_the_definition():
    rng = random.Random(1)
    texts = ["", " \t\n", "one", "One TWO three", "a b c d", "a b c d e", "É é X", "  a b",
             " ".join(rng.choice("abcdefg") for _ in range(70_000))]
    texts += [" ".join(rng.choice(["Ab", "c", "dé", "f."]) for _ in range(n)) for n in range(40)]
    assert [int(x) for x in op._fingerprints(texts, 4)] == [brute_print(t) for t in texts]


def test_documents_of_the_smallest_set(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = [(r.doc_id, brute_print(r.text)) for r in docs.collect()]
    want = {k: (f"{p:016x}", c) for (k, p), c in zip(pairs, brute_components(pairs))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op.near_duplicates(docs).collect()}
    assert got == want


@pytest.mark.parametrize("blocks,shard_rows", [(None, 4096), (5, 4096), (6, 8), (7, 4096), (9, 2)])
def test_links_in_dense_and_chained_numbers(spark, blocks, shard_rows):
    rng = random.Random(7)
    numbers = {0, 2**64 - 1, 1 << 63}
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(40):  # a chain whose ends are far apart
            numbers.add(x)
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
    numbers |= {rng.getrandbits(64) for _ in range(100)}
    signed = np.array(sorted(numbers), np.uint64).view(np.int64).tolist()
    edges = op.linked(spark.createDataFrame([(v,) for v in signed], "fp long"), blocks=blocks, shard_rows=shard_rows)
    found = {r.u: r.v for r in op.components(edges).collect()}
    pairs = [(i, v & (2**64 - 1)) for i, v in enumerate(signed)]
    groups, want = {}, {}
    for v in signed:
        groups.setdefault(found.get(v, v), set()).add(v)
    for v, c in zip(signed, brute_components(pairs)):
        want.setdefault(c, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_nulls_repeated_rows_and_extra_columns(spark, docs_of):
    docs = docs_of([(3, None), (2, ""), (None, " "), (5, "a b c d e"), (5, "a b c d e"), (None, "q r s t u v")])
    docs = docs.withColumns({c: F.lit("x") for c in ("fp", "id", "component_id", "shard", "u")})
    got = sorted((tuple(r) for r in op.near_duplicates(docs).select("doc_id", "component_id").collect()), key=repr)
    assert got == sorted([(3, 2), (2, 2), (None, 2), (5, 5), (5, 5), (None, None)], key=repr)
    assert op.near_duplicates(docs_of([])).count() == 0


def test_field_count_grows_with_the_rows():
    assert op.field_count(1000) == 6 and op.field_count(10**10) > 7
