"""Joins against a side that is expected to be small, and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import materialize

def join_small(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``big`` with a table that is small in the usual case.

    The small side is written once, so that the planner knows its size in bytes: within Spark's own limit it is
    broadcast and the big side is not shuffled at all; beyond that, adaptive skew handling splits hot keys.
    """
    return big.join(materialize(small, "small-side"), list(on), how)


def attach(df: DataFrame, values: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Attach the columns of ``values`` by key, refusing a key that would multiply rows."""
    duplicate = values.groupBy(key).count().where("count > 1").select(key).take(1)
    if duplicate:
        raise ValueError(f"{key} is not unique in the attached table, for example {duplicate[0][0]!r}")
    return df.join(values, key, how)


def update_rows(df: DataFrame, repairs: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` of the rows whose key has a non-null repair; every other row is kept as it is."""
    fixes = repairs.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = attach(df, fixes, key, "left")
    return joined.select(
        *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project ``columns`` in order; missing ones are reported together before any job starts."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def head_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows in key order (top-k, no global sort)."""
    return df.orderBy(key).limit(n)
