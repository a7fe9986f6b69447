"""Column profiles: frame info, null counts, summaries, value counts, histograms, densities and box statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from .joins import join_small
from .ordering import LOCAL_ROWS
from .quantiles import exact_quantiles, numeric_long


def _melted(row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn a one-row frame with ``<column>:<field>`` columns into one row per column."""
    cells = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"`{c}:{f}`").alias(f) for f in fields]) for c in columns
    ]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def frame_info(df: DataFrame) -> DataFrame:
    """(feature, dtype, n_rows, n_non_null) for every column, in one pass."""
    row = df.agg(
        *[F.count(c).alias(f"{c}:n_non_null") for c in df.columns],
        *[F.count(F.lit(1)).alias(f"{c}:n_rows") for c in df.columns],
    ).withColumns({f"{c}:dtype": F.lit(t) for c, t in df.dtypes})
    return _melted(row, df.columns, ["dtype", "n_rows", "n_non_null"])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, n_null), in one pass; NaN counts as missing in floating-point columns."""
    types = dict(df.dtypes)

    def missing(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c) if types[c] in ("double", "float") else F.col(c).isNull()

    columns = list(columns or df.columns)
    row = df.agg(*[F.count_if(missing(c)).alias(f"{c}:n_null") for c in columns])
    return _melted(row, columns, ["n_null"])


def _as_text(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    texts = df.select(*by, *[F.col(c).cast("string").alias(f"_{c}") for c in columns])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"_{c}").alias("value")) for c in columns]
    return texts.select(*by, F.inline(F.array(*cells)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) with null kept as a value; all columns share one scan and one shuffle of counts."""
    return _as_text(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def by_frequency(counts: DataFrame) -> DataFrame:
    """Most frequent values first within each feature, equal counts by value."""
    return counts.orderBy("feature", F.desc("n"), F.asc_nulls_last("value"))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """(value, n, proportion) of one column, nulls left out of both sides of the division."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double"))
    return counts.select("value", "n", (F.col("n").cast("double") / total.scalar()).alias("proportion"))


def describe_numeric(
    df: DataFrame, columns: Sequence[str], method: str = "exact", local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """(feature, count, mean, std, min, p25, p50, p75, max) with interpolated quartiles and ddof = 1."""
    moments = {"mean": F.avg("value"), "std": F.stddev_samp("value"), "min": F.min("value"), "max": F.max("value")}
    found = exact_quantiles(df, columns, (0.25, 0.5, 0.75), method=method, local_rows=local_rows, extra=moments)
    quartiles = [F.col("edges")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))]
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(found, "feature", "left").select(
        "feature", F.coalesce("n", F.lit(0)).alias("count"), "mean", "std", "min", *quartiles, "max")


def _range(df: DataFrame, column: str) -> tuple[DataFrame, float | None, float | None, int, float | None]:
    value = numeric_long(df, [column])
    lo, hi, n, std = value.agg(F.min("value"), F.max("value"), F.count("value"), F.stddev_samp("value")).first()
    return value, lo, hi, n, std


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """(bin, lo, hi, n) for equal-width bins over the data range; the last bin is closed, empty bins are kept."""
    value, lo, hi, n, _ = _range(df, column)
    if not n:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n long")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    edge = lambda i: F.lit(lo) + i * F.lit(width)
    guess = F.least(F.floor((F.col("value") - lo) / width), F.lit(bins - 1)).cast("int")
    # The division can land one bin off at an edge; the edges decide.
    exact = (
        F.when((guess > 0) & (F.col("value") < edge(guess)), guess - 1)
        .when((guess < bins - 1) & (F.col("value") >= edge(guess + 1)), guess + 1)
        .otherwise(guess)
    )
    counts = value.groupBy(exact.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    upper = F.when(F.col("bin") == bins - 1, F.lit(hi)).otherwise(edge(F.col("bin") + 1))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin", edge(F.col("bin")).alias("lo"), upper.alias("hi"), F.coalesce("n", F.lit(0)).alias("n")
    )


def kde(df: DataFrame, column: str, bins: int = 20, points: int = 200) -> DataFrame:
    """(point, x, y): Gaussian density over the data range, scaled to the counts of the histogram.

    Each distinct value is a vector of ``points`` kernel heights, summed with its count as weight by the partial
    aggregates, so no row per (value, point) pair is ever produced or shuffled.
    """
    value, lo, hi, n, std = _range(df, column)
    if n < 2 or not std:
        raise ValueError(f"{column}: a density needs at least two different values")
    bandwidth = std * n ** (-1 / 5)
    grid = [lo + i * (hi - lo) / (points - 1) for i in range(points)]
    scale = (hi - lo) / bins / (bandwidth * (2 * math.pi) ** 0.5)
    counts = value.groupBy("value").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    z = lambda x: (F.col("value") - x) / F.lit(bandwidth)
    heights = F.transform(F.lit(grid), lambda x: F.exp(F.lit(-0.5) * z(x) * z(x)))
    sums = counts.select("weight", array_to_vector(heights).alias("heights")).agg(
        vector_to_array(Summarizer.sum(F.col("heights"), F.col("weight"))).alias("sums")
    )
    return sums.select(F.posexplode("sums").alias("point", "y")).select(
        "point", F.get(F.lit(grid), F.col("point")).alias("x"), (F.col("y") * scale).alias("y")
    )


def box_stats(
    df: DataFrame, by: str, columns: Sequence[str], whisker: float = 1.5, local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """(by, feature, n, q1, med, q3, whislo, whishi, n_outliers) per group and column."""
    cells = _fenced(df, by, columns, whisker, local_rows)
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    stats = cells.groupBy(by, "feature").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(c).alias(c) for c in ("q1", "med", "q3")],
        F.min(F.when(inside, F.col("value"))).alias("lowest"),
        F.max(F.when(inside, F.col("value"))).alias("highest"),
        F.count_if(~inside).alias("n_all_out"),
    )
    return stats.select(
        by, "feature", "n", "q1", "med", "q3",
        F.least("lowest", "q1").alias("whislo"), F.greatest("highest", "q3").alias("whishi"),
        F.col("n_all_out").alias("n_outliers"),
    )


def box_outliers(
    df: DataFrame, key: str, by: str, columns: Sequence[str], whisker: float = 1.5, local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """(key, by, feature, value) of the cells outside the fences of their group."""
    cells = _fenced(df, by, columns, whisker, local_rows, key)
    outside = ~F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return cells.where(outside).select(key, by, "feature", "value")


def _fenced(
    df: DataFrame, by: str, columns: Sequence[str], whisker: float, local_rows: int, key: str | None = None
) -> DataFrame:
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75), by=[by], local_rows=local_rows)
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    fences = quartiles.select(
        by, "feature", *[F.col("edges")[i].alias(q) for i, q in enumerate(("q1", "med", "q3"))]
    ).withColumns({"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})
    kept = [key, by] if key else [by]
    return join_small(numeric_long(df, columns, kept), fences, [by, "feature"])

