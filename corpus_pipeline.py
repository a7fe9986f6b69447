"""A corpus cleaning pipeline: each stage is written as Parquet and read again as the next one's documents.

Stages keep the columns of the documents, whatever they are called; the last one adds the ids of the text. Null ids and
texts, repeated rows and empty tables have the results that the operators define for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm import decontaminate, exact_dedup, language_id, sentencepiece, simhash
from riskspark.llm.common import documents, with_answer
from riskspark.session import materialize
from riskspark.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in none of the learned languages, go."""
    return language_id.known_rows(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.first_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints stays."""
    return simhash.first_rows(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token_ids, n_tokens, and round_trip: whether decoding the ids gives the text back.

    Columns of the documents keep their names and values; an added column whose name is taken ends in ``_``.
    """
    answer = F.col("__answer")
    packed = with_answer(docs, sentencepiece.encoding(docs))
    own = [F.col(f"__row.`{c}`") for c in docs.columns]
    added = {"token_ids": answer["ids"], "n_tokens": F.size(answer["ids"]).cast("bigint"), "round_trip": answer["round_trip"]}
    taken = {c.lower() for c in docs.columns}
    for name, column in added.items():
        while name in taken:
            name += "_"
        own.append(column.alias(name))
        taken.add(name)
    return packed.select(*own)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_languages),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_passages),
    ("sentencepiece", piece_ids),
]

#: No SQL can express the language, fingerprint and tokenizer stages; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
