import hashlib
import re

import pytest
from pyspark.sql import functions as F

from riskspark.llm import exact_dedup as op

TEXTS = ["a b", "ab", " a\tb\n", None, "", "  ", "é", "é", "a b", "x" * 50_000, "x" * 50_000 + " ", "ab"]


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in pairs:
        body = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[body])
        out.append((i, best[3], len(groups[body]), (i, -len(t or "")) == (best[3], best[0]),
                    hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [op.sha256, lambda c: F.substring(op.sha256(c), 1, 1), lambda c: F.lit("one")])
def test_against_brute_force_even_with_clashing_digests(spark, docs_of, digest):
    pairs = list(enumerate(TEXTS, 1)) + [(None, "only null"), (None, "ab"), (2**63 - 1, "q q"), (-(2**63), "qq "), (2, "ab")]
    got = op.mark(docs_of(pairs), salts=3, digest=digest)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(pairs)


@pytest.mark.parametrize("digest", [op.sha256, lambda c: F.lit("one")])
def test_first_rows_keep_all_columns_and_one_row_of_each_text(spark, docs_of, digest):
    docs = docs_of([(1, "ab"), (2, "a  b"), (2, "a  b"), (3, "c"), (None, "d"), (None, None)])
    docs = docs.withColumns({c: F.lit(0) for c in ("keep_id", "digest", "content", "rank", "row", "nth")})
    got = op.first_rows(docs, digest=digest)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(2, "a  b"), (3, "c"), (None, "d"), (None, None)], key=repr)


def test_empty_table(docs_of):
    assert op.mark(docs_of([])).count() == 0
    assert op.first_rows(docs_of([])).count() == 0
