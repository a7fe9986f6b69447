"""Exact stratified train/test split by key hash.

Each class gets an exact number of test rows. Hash prefixes are counted first, whole prefixes below the quota need no
ordering, and only the prefix where the quota ends is sorted to find the cut. Assigning a row is then a comparison
with the cut of its class, so the table itself is never shuffled.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

#: Rows that one task orders to find a class's cut; the depth of the hash prefix follows from it and the counted rows.
SORTED_ROWS = 100_000


def class_quotas(counts: DataFrame, label: str, test_size: float) -> DataFrame:
    """(label, n, n_train, n_test) by largest remainder over the class counts; equal remainders go by label.

    ``counts`` has one row per class.
    """
    share = Fraction(str(test_size))
    one = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(one)
    # ceil(total * share) in whole numbers
    n_test = F.expr(f"(sum(n) over () * {share.numerator} + {share.denominator - 1}) div {share.denominator}")
    sized = counts.withColumns({"_total": total, "_train": total - n_test})
    exact = "cast(n as decimal(19,0)) * _train"
    sized = sized.withColumns(
        {
            "_floor": F.expr(f"cast(({exact}) div _total as bigint)"),
            "_rest": F.expr(f"cast(({exact}) % _total as bigint)"),
        }
    )
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), F.asc(label)))
    missing = F.col("_train") - F.sum("_floor").over(one)
    n_train = F.col("_floor") + F.when(rank <= missing, 1).otherwise(0)
    return sized.withColumn("n_train", n_train).select(
        label, "n", "n_train", (F.col("n") - F.col("n_train")).alias("n_test")
    )


def _prefix_digits(rows: int) -> int:
    """Hexadecimal digits after which a prefix holds about ``SORTED_ROWS`` rows."""
    digits = 2
    while rows > SORTED_ROWS * 16**digits:
        digits += 1
    return digits


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """``df`` with ``is_test``; disjoint, exhaustive, and independent of row order and partitioning.

    Reads (key, label) twice before the result is scanned; pass a written table when computing ``df`` is expensive.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    digits = _prefix_digits(df.count())
    prefixed = hashed.select(key, label, "_hash", F.substring("_hash", 1, digits).alias("_prefix"))
    cells = materialize(prefixed.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("n")), "split-cells")
    counts = cells.groupBy(label).agg(F.sum("n").alias("n"))
    nulls, singles = counts.agg(F.count_if(F.col(label).isNull()), F.count_if(F.col("n") < 2)).first()
    if nulls:
        raise ValueError(f"{label} has nulls; set those rows aside before splitting")
    if singles:
        raise ValueError(f"every class of {label} needs at least two rows")
    quotas = class_quotas(counts, label, test_size).select(label, "n_test")
    earlier = Window.partitionBy(label).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        cells.join(quotas, label)
        .withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .where((F.col("_before") < F.col("n_test")) & (F.col("_before") + F.col("n") >= F.col("n_test")))
        .select(label, "_prefix", (F.col("n_test") - F.col("_before")).alias("_take"))
    )
    # Only the rows of one prefix per class are ordered here.
    order = Window.partitionBy(label).orderBy("_hash", key)
    # Were the next row's key the same, both would fall on one side of the cut and the quota would be missed.
    again = F.lead(key).over(order).eqNullSafe(F.col(key))
    repeated = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string"))).cast("int")
    cut = (
        prefixed.join(edge, [label, "_prefix"])
        .withColumn("_rank", F.row_number().over(order))
        .withColumn("_rank", F.when((F.col("_rank") == F.col("_take")) & again, repeated).otherwise(F.col("_rank")))
        .where(F.col("_rank") == F.col("_take"))
        .select(label, F.struct("_hash", key).alias("_cut"))
    )
    # Written, so that every later scan of the result is one scan.
    cut = materialize(cut, "split-cut")
    assigned = hashed.join(cut, label, "left")
    is_test = F.coalesce(F.struct("_hash", key) <= F.col("_cut"), F.lit(False))
    return assigned.withColumn("is_test", is_test).select(*df.columns, "is_test")
