"""One-hot encoding with sorted categories, and the collapse of equal feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F


def categories(df: DataFrame, columns: Sequence[str], max_categories: int | None = None) -> list[list[str]]:
    """Sorted distinct non-null values per column in the order of their own type (2 before 10).

    The fitted encoder holds its categories in memory by nature; ``max_categories`` refuses columns with more of them.
    """
    if max_categories is not None:
        sizes = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
        wide = {c: sizes[c] for c in columns if sizes[c] > max_categories}
        if wide:
            raise ValueError(f"too many categories to encode one-hot: {wide}")
    return [[r[0] for r in df.select(F.col(c)).where(F.col(c).isNotNull()).distinct().orderBy(c).select(
        F.col(c).cast("string")).toLocalIterator()] for c in columns]


def fit_encoder(
    df: DataFrame, columns: Sequence[str], features_col: str = "features", max_categories: int | None = None
) -> PipelineModel:
    """Blocks in ``columns`` order; an unseen or null category is an all-zero block."""
    index = [f"_{c}_index" for c in columns]
    hot = [f"_{c}_hot" for c in columns]
    indexers = [
        StringIndexerModel.from_labels(values, inputCol=c, outputCol=i, handleInvalid="keep")
        for c, i, values in zip(columns, index, categories(df, columns, max_categories))
    ]
    # The extra "keep" level is the dropped one, which makes it the zero vector.
    encoder = OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True)
    assembler = VectorAssembler(inputCols=hot, outputCol=features_col)
    # Sizes come from the indexers' metadata, so fitting the encoder needs no rows.
    indexed = PipelineModel(indexers).transform(df.select(*columns).limit(0))
    fitted = Pipeline(stages=[encoder, assembler]).fit(indexed)
    return PipelineModel([*indexers, *fitted.stages])


def known_categories(encoder: PipelineModel) -> list[tuple[str, list[str]]]:
    """(column, categories) of every block, in vector order."""
    return [(s.getInputCol(), list(s.labels)) for s in encoder.stages if isinstance(s, StringIndexerModel)]


def feature_names(encoder: PipelineModel) -> list[tuple[str, str]]:
    """(column, category) of every position of the feature vector."""
    return [(c, v) for c, values in known_categories(encoder) for v in values]


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_") and c.endswith(("_index", "_hot"))])


def category_table(spark: SparkSession, encoder: PipelineModel) -> DataFrame:
    """(position, feature, category) of every position of the feature vector, as a table."""
    rows = [(i, c, v) for i, (c, v) in enumerate(feature_names(encoder))]
    return spark.createDataFrame(rows, "position int, feature string, category string")


def feature_cells(
    df: DataFrame, key: str, encoder: PipelineModel, features_col: str = "features", keep: Sequence[str] = ()
) -> DataFrame:
    """(key, position, feature, category, value, keep...) of the non-zero cells of the encoded rows."""
    # Zeros go before anything is made of them, so a row gives as many rows as it has non-zero cells.
    cells = F.filter(
        F.transform(vector_to_array(features_col), lambda v, i: F.struct(i.alias("position"), v.alias("value"))),
        lambda cell: cell["value"] != 0)
    found = df.select(key, *keep, F.inline(cells))
    return found.join(category_table(df.sparkSession, encoder), "position").select(
        key, "position", "feature", "category", "value", *keep)


def unseen_counts(df: DataFrame, encoder: PipelineModel) -> DataFrame:
    """(feature, n_unseen): non-null values that the encoder does not know, which score as zeros."""
    columns = [c for c, _ in known_categories(encoder)]
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = texts.unpivot([], columns, "feature", "category").where("category is not null").groupBy("feature", "category").agg(
        F.count(F.lit(1)).alias("n"))
    unseen = counts.join(category_table(df.sparkSession, encoder).drop("position"), ["feature", "category"], "left_anti")
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return every.join(unseen.groupBy("feature").agg(F.sum("n").alias("n")), "feature", "left").select(
        "feature", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_unseen"))


def collapse(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal rows merged into one with their number in ``n``.

    Binned and encoded features take few distinct combinations, so training and evaluation on the merged rows with
    ``n`` as weight give the results of the full table after one map-side combined pass.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
