"""One-hot encoding against a written dictionary, for columns with more categories than a driver should hold.

``build_dictionary`` counts the categories of all columns in one pass, ranks them by a range-split sort with prefix counts and
writes (position, block, feature, category, n). ``encode`` finds the positions by a join on the category. Positions are those
of ``encode.fit_encoder``: columns in the given order, the categories of a column in the order of their own type.

Hot categories: an entry with more than ``hot_share`` of its column's rows is broadcast, and a column has less than
``1 / hot_share`` of these, so the broadcast is bounded whatever the table. All other cells go to the rest of the dictionary,
where no category has more than ``hot_share`` of the rows; Spark broadcasts that rest as well if it is within its own limit.

Defined cases: null and unknown categories have no position, so a row without any known one has an empty list and an all-zero
vector. An empty table gives an empty dictionary. Keys are unique and not null. The table is read twice by ``encode``: pass a
written one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .ordering import LOCAL_ROWS, ordered

#: Share of a column's rows above which a category's entry is broadcast.
HOT_SHARE = 0.002


def _cells(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """One row per column of a row: (keep..., block, feature, category, whole, real).

    ``whole`` and ``real`` order numbers by value; they are null for columns of other types, which go by their text.
    """
    structs = []
    for block, name in enumerate(columns):
        kind = df.schema[name].dataType
        whole = isinstance(kind, (T.IntegralType, T.BooleanType))
        real = isinstance(kind, (T.FractionalType, T.DecimalType))
        structs.append(F.struct(
            F.lit(block).alias("block"), F.lit(name).alias("feature"), F.col(name).cast("string").alias("category"),
            (F.col(name) if whole else F.lit(None)).cast("bigint").alias("whole"),
            (F.col(name) if real else F.lit(None)).cast("double").alias("real")))
    return df.select(*keep, F.inline(F.array(*structs)))


def build_dictionary(df: DataFrame, columns: Sequence[str], local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(position, block, feature, category, n) of all non-null categories; ``n`` is the number of rows that have it."""
    counted = _cells(df, columns).where("category is not null").groupBy("block", "feature", "whole", "real", "category").agg(
        F.count(F.lit(1)).alias("n"), F.lit(1).cast("bigint").alias("one"))
    ranked = ordered(counted, ["block", "whole", "real", "category"], local_rows=local_rows).scan(sums={"place": "one"})
    return materialize(
        ranked.select((F.col("place") - 1).alias("position"), "block", "feature", "category", "n"), "dictionary")


def width(dictionary: DataFrame) -> int:
    """Positions of a vector."""
    return dictionary.count()


def _split(dictionary: DataFrame, hot_share: float) -> tuple[DataFrame, DataFrame]:
    """(hot, rest) entries. There are less than ``1 / hot_share`` hot ones in a column."""
    rows = dictionary.groupBy("feature").agg(F.sum("n").alias("rows"))
    marked = dictionary.join(F.broadcast(rows), "feature").withColumn("hot", F.col("n") > hot_share * F.col("rows"))
    marked = materialize(marked.select("position", "feature", "category", "hot"), "dictionary-split", partition_by="hot")
    return marked.where("hot").drop("hot"), marked.where("not hot").drop("hot")


def _positions(
    df: DataFrame, key: str, dictionary: DataFrame, columns: Sequence[str], hot_share: float
) -> tuple[DataFrame, DataFrame]:
    """Every cell with its position if its category is hot, and the cells of the other known categories."""
    hot, rest = _split(dictionary, hot_share)
    cells = _cells(df, columns, key).select(key, "feature", "category")
    first = cells.join(F.broadcast(hot), ["feature", "category"], "left").select(key, "feature", "category", "position")
    others = first.where("position is null and category is not null").drop("position")
    return first, others.join(rest, ["feature", "category"]).select(key, "feature", "category", "position")


def encoded_cells(
    df: DataFrame, key: str, dictionary: DataFrame, columns: Sequence[str], hot_share: float = HOT_SHARE
) -> DataFrame:
    """(key, position, feature, category) of the cells with a known category."""
    first, others = _positions(df, key, dictionary, columns, hot_share)
    return first.where("position is not null").unionByName(others).select(key, "position", "feature", "category")


def encode(
    df: DataFrame, key: str, dictionary: DataFrame, columns: Sequence[str], hot_share: float = HOT_SHARE
) -> DataFrame:
    """(key, indices): the ascending positions of a row's ones, at most one of each column."""
    first, others = _positions(df, key, dictionary, columns, hot_share)
    # All rows are in the first part, so one without a known category keeps its place with an empty list.
    found = first.select(key, "position").unionByName(others.select(key, "position"))
    return found.groupBy(key).agg(F.array_sort(F.collect_list("position")).alias("indices"))


def sparse_vectors(encoded: DataFrame, size: int, features_col: str = "features") -> DataFrame:
    """``encoded`` with a sparse vector of ``size`` positions in place of ``indices``, made without Python."""
    ones = F.transform("indices", lambda _: F.lit(1.0))
    parts = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), F.col("indices").alias("indices"), ones.alias("values"))
    shape = T.StructType([T.StructField("v", VectorUDT())])
    vector = F.from_json(F.to_json(F.struct(parts.alias("v"))), shape)["v"]
    return encoded.withColumn(features_col, vector).drop("indices")
