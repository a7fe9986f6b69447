import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from riskspark.llm import language_id, sentencepiece
from test_decontaminate import brute as brute_hits
from test_simhash import brute_components, brute_print

FOLDER = "/root/testdata/sf0.001"


def brute(rows, items):
    """The ids that stay, by plain loops; language decisions are the operator's own, as they are learned."""
    best = {}
    for r in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        best[body] = min(best.get(body, (1, 0, None)), (-len(r.text), r.doc_id, r), key=lambda x: x[:2])
    rows = [b[2] for b in best.values()]
    parts = brute_components([(r.doc_id, brute_print(r.text)) for r in rows])
    rows = [r for r, c in zip(rows, parts) if r.doc_id == c]
    hit = {h[0] for h in brute_hits([(r.doc_id, r.text) for r in rows], items) if h[5]}
    return {r.doc_id for r in rows} - hit


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    said = {r.doc_id: r for r in language_id.identify(docs).collect()}
    known = [r for r in docs.collect()
             if said[r.doc_id].lang_pred != "und" and said[r.doc_id].score >= language_id.LEAST_SCORE]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in pipeline.run(spark, FOLDER).collect()}
    assert set(got) == brute(known, items)
    pieces = sentencepiece.Pieces.load(sentencepiece.MODEL)
    assert all(pieces.decode(r.token_ids) == r.text and r.n_tokens == len(r.token_ids) for r in got.values())
    assert all(r.round_trip for r in got.values())


def test_stages_keep_columns_whatever_their_names(spark, docs_of):
    words = "the quick brown fox jumps over a lazy dog and more words follow here".split()
    texts = [" ".join(words[i:] + words[:i]) for i in range(12)]
    rows = [*enumerate(texts), *enumerate(texts), (None, texts[0] + "."), (50, None), (51, ""), (52, "1 2"), (53, "x" * 90_000)]
    clash = ("__row", "fp", "id", "content", "digest", "row", "nth", "keep_id", "component_id", "ids", "token_ids", "__name")
    docs = docs_of(rows).withColumn("lang", F.lit("en")).withColumns({c: F.lit(1) for c in clash})
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns, name
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    found = pipeline.STAGES[-1][1](spark, docs, FOLDER)
    rows = found.collect()
    ids = Counter(r.doc_id for r in rows)
    assert found.columns == [*docs.columns, "token_ids_", "n_tokens", "round_trip"]
    assert all(r.token_ids == 1 and len(r.token_ids_) == r.n_tokens for r in rows)
    assert max(ids.values()) == 1 and not ids.keys() & {50, 51, 52}


@pytest.mark.parametrize("nth", range(5))
def test_stages_on_an_empty_table(spark, docs_of, nth):
    assert pipeline.STAGES[nth][1](spark, docs_of([]), FOLDER).count() == 0
