"""Registered queries of this subpackage, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import collocations, decontaminate, exact_dedup, html_extract, language_id, license_scan, line_dedup, lm_score, sentencepiece, shard_ring, simhash, suffix_dedup, token_alignment
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece.encode(documents(spark, folder))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark(documents(spark, folder))


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, folder), kept=False)


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, folder, "pages"))


def op5_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.main_texts(table(spark, folder, "pages"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(documents(spark, folder))


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(documents(spark, folder))


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.scan(documents(spark, folder), table(spark, folder, "benchmark"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(documents(spark, folder))


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_ring.assign(documents(spark, folder))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align(documents(spark, folder))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(documents(spark, folder))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_exact_dedup, op3_suffix_array_dedup, op4_line_dedup, op5_html_extract, op6_language_id,
        op7_simhash_near_dedup, op8_lm_score, op9_benchmark_decontamination, op10_license_scan,
        op11_sharding, op12_token_alignment, op13_collocations,
    )
}
ORACLES: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_line_dedup": line_dedup.sql(),
    "op9_benchmark_decontamination": decontaminate.SQL,
    "op13_collocations": collocations.SQL,
}
