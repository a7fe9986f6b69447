"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.tables import table

#: Rows sent to a Python worker at once. Texts can be long, so a batch holds few of them.
BATCH_ROWS = 1000


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch, as texts of a hundred thousand characters occur."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def crc_fold(key: str | Column, folds: int) -> Column:
    """Fold of a row: crc32 of its id as text, modulo ``folds``; a null id is in the fold of the empty text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def with_answer(docs: DataFrame, answer: Column, name: str = "__answer") -> DataFrame:
    """``docs`` packed as struct column ``__row`` beside ``answer``: no column of ``docs`` can clash with it."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if docs.columns else F.lit(None)
    return docs.select(row.alias("__row"), answer.alias(name))


def kept_rows(answered: DataFrame, condition: Column) -> DataFrame:
    """The rows for which ``condition`` holds, with the columns they came with."""
    return answered.where(condition).select("__row.*")


def struct_type(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])
