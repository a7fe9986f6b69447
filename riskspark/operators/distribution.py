"""Target distributions conditioned on features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .profile import _as_text

FREE_TEXT = ("description",)


def conditional_distribution(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, dropna: bool = True,
    classes: Sequence[str] | None = None,
) -> DataFrame:
    """(feature, value, target, n, share): P(target | feature = value).

    One scan for all columns. ``columns`` defaults to everything but the target and free text; ``dropna`` leaves out
    rows whose value is null, and rows without a target never count. When the possible ``classes`` are named, their
    counts travel as columns of one row per value and a single shuffle is enough; a target outside them is an error.
    """
    columns = list(columns or [c for c in df.columns if c != target and c not in FREE_TEXT])
    cells = _as_text(df.where(F.col(target).isNotNull()), columns, [target])
    if dropna:
        cells = cells.where(F.col("value").isNotNull())
    if classes:
        return _by_known_class(cells, target, classes)
    counts = cells.groupBy("feature", "value", target).agg(F.count(F.lit(1)).alias("n"))
    # The window holds one row per class of a value, not the rows behind them.
    total = F.sum("n").over(Window.partitionBy("feature", "value"))
    return counts.select(
        "feature", "value", F.col(target).alias("target"), "n",
        (F.col("n").cast("double") / total.cast("double")).alias("share"),
    )


def _by_known_class(cells: DataFrame, target: str, classes: Sequence[str]) -> DataFrame:
    counts = cells.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("all"), *[F.count_if(F.col(target) == c).alias(f"n{i}") for i, c in enumerate(classes)]
    )
    known = sum((F.col(f"n{i}") for i in range(len(classes))), F.lit(0))
    unknown = F.raise_error(F.concat(F.lit("unknown target for "), "feature", F.lit(" = "), F.coalesce("value", F.lit("null"))))
    total = F.when(known == F.col("all"), F.col("all")).otherwise(unknown.cast("long"))
    rows = F.array(*[F.struct(F.lit(c).alias("target"), F.col(f"n{i}").alias("n")) for i, c in enumerate(classes)])
    return counts.select("feature", "value", total.alias("_total"), F.inline(rows)).where("n > 0").select(
        "feature", "value", "target", "n", (F.col("n").cast("double") / F.col("_total").cast("double")).alias("share")
    )


def group_mean(df: DataFrame, by: str, column: str) -> DataFrame:
    """(by, n, mean) of a column per group."""
    return df.groupBy(by).agg(F.count(column).alias("n"), F.avg(column).alias("mean"))


def group_share(df: DataFrame, by: str, target: str) -> DataFrame:
    """(by, target, n, share) of the target classes within each group."""
    counts = df.where(F.col(by).isNotNull() & F.col(target).isNotNull()).groupBy(by, target).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n").over(Window.partitionBy(by))
    return counts.withColumn("share", F.col("n").cast("double") / total.cast("double"))
