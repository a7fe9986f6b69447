"""Cross-tokenizer alignment against a plain version that keeps every link."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskspark.llm import token_alignment as ta


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def made():
    return ta.Tokenizers(open(ta.BYTE_MODEL, "rb").read(), open(ta.PIECE_MODEL, "rb").read())


def plain(texts, made):
    """Figures of each text, by offsets one by one."""
    docs, counts, best = [], Counter(), defaultdict(int)
    for text in texts:
        text = text or ""
        a = made.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = made.b.encode(text) if text else []
        whole = (" " + text).encode()
        if b"".join(made.bytes_a[i] for i in a) != whole or b"".join(made.bytes_b[i] for i in b) != whole:
            a, b = [], []
        ends = []
        for ids, size in ((a, made.bytes_a), (b, made.bytes_b)):
            at, of = 0, {}
            for n, i in enumerate(ids):
                at += len(size[i])
                of[at] = n
            ends.append(of)
        groups, links, x, y = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0][end], ends[1][end]
            groups.append(",".join(map(str, a[x:i + 1])) + "|" + ",".join(map(str, b[y:j + 1])))
            links.append((a[i], b[j]))
            x, y = i + 1, j + 1
        counts.update(links)
        docs.append((len(a), len(b), groups, links))
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(na, nb, len(g), len(li), sum(counts[p] == best[p[1]] for p in li), sum(counts[p] for p in li),
             hashlib.sha256(";".join(g).encode()).hexdigest() if na else "") for na, nb, g, li in docs]


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "the the the the", "", None, "Ünïcödé — naïve café 漢字 \U0001f600!",
    "a\tb\n\nc  d   e", " leading and trailing ", "<|endoftext|> and </s> and <unk> are text", "low ▁ bar",
    "x" * 5000, "1234567890 3.14159", "<0x0A> is six letters", "The quick brown fox jumps over the lazy dog.",
    "  ​ blanks", "null \x00 byte", "\r\n", "é combining",
]


@pytest.mark.parametrize("chunk", [1, 64, ta.CHUNK_BYTES])
def test_against_plain(spark, docs_of, made, chunk):
    docs = docs_of(TEXTS)
    want = sorted((i, *x) for i, x in enumerate(plain(TEXTS, made), 1))
    assert rows(ta.align(docs, chunk_bytes=chunk)) == sorted(want, key=repr)


def test_documents_of_the_small_table(spark, made):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = docs.collect()
    want = sorted((r.doc_id, *x) for r, x in zip(texts, plain([r.text for r in texts], made)))
    got = sorted(tuple(r) for r in ta.align(docs.repartition(3), chunk_bytes=60_000).collect())
    assert got == want


def test_repeated_rows_null_ids_and_clashing_columns(spark, made):
    docs = spark.createDataFrame(
        [(None, "one two", 1), (None, "one two", 1), (7, "one two", 1), (7, None, 1)], "doc_id long, text string, chunk int")
    want = plain(["one two", "one two", "one two", None], made)
    assert rows(ta.align(docs)) == sorted([(None, *want[0]), (None, *want[1]), (7, *want[2]), (7, *want[3])], key=repr)


def test_empty_table(spark, docs_of):
    found = ta.align(docs_of([]).where("false"))
    assert found.count() == 0 and found.columns[0] == "doc_id"


def test_pair_counts(spark, docs_of, made):
    found = {(r.a, r.b): (r.documents, r.links) for r in ta.pair_counts(ta.segments(docs_of(["no no no", "no yes"]), chunk_bytes=1)).collect()}
    a, b = made.a.encode(" no", add_special_tokens=False).ids, made.b.encode("no")
    assert found[a[0], b[0]] == (2, 4)


def test_bitmaps_give_their_documents_back():
    rng = np.random.default_rng(1)
    for docs in (1, 7, 8, 9, 1000, 65536):
        times = {(p, int(d)): int(t) for p in range(6) for d, t in zip(
            rng.choice(docs, max(1, docs // 3 ** p), replace=False), rng.integers(1, 9, docs))}
        pair = np.array([p for (p, _), t in times.items() for _ in range(t)])
        doc = np.array([d for (_, d), t in times.items() for _ in range(t)])
        pairs, planes = ta.postings(pair, doc, docs)
        n_docs, n_links = ta.counts_of(planes, len(pairs), docs)
        assert n_docs.tolist() == [sum(q == p for q, _ in times) for p in pairs]
        assert n_links.tolist() == [sum(t for (q, _), t in times.items() if q == p) for p in pairs]
        back = Counter()
        for weight, owner, d in ta._places(planes, len(pairs), docs):
            for o, x in zip(owner.tolist(), d.tolist()):
                back[int(pairs[o]), x] += weight
        assert back == Counter(times)


def test_group_texts_from_one_number_per_id():
    """Against text put together group by group; digits are single numbers, not rows of bytes."""
    from riskspark.llm import token_alignment as alignment

    made = alignment.Tokenizers(*(open(p, "rb").read() for p in (alignment.BYTE_MODEL, alignment.PIECE_MODEL)))
    assert made.digits.ndim == 1
    texts = ["", "Plain words, 1234567890 and naïve cafés", "", "x", "tab\tand  two spaces", ""]
    ids = made.encode(texts)
    want = []
    for a, b in ids:
        groups, i, j = [], 0, 0
        while i < len(a):
            first = i, j
            i, j = i + 1, j + 1
            while (x := sum(made.len_a[a[:i]])) != (y := sum(made.len_b[b[:j]])):
                i, j = (i + 1, j) if x < y else (i, j + 1)
            groups.append(f"{','.join(map(str, a[first[0]:i]))}|{','.join(map(str, b[first[1]:j]))}")
        want.append(";".join(groups).encode())
    assert alignment.Aligned(made, ids).group_texts() == want
