"""Exact interpolated quantiles of many columns, per group or over the whole table.

``percentile`` keeps one map of all distinct values of a group, which is right for groups that fit in a task. Groups
above ``local_rows`` are narrowed instead: each pass counts a fixed number of buckets per group with map-side
combining, keeps only the bucket that holds the wanted rank, and stops when the bucket is small or a single value.
No pass shuffles more than the bucket counts, so a group with most of the table costs the same as any other.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .joins import join_small
from .ordering import LOCAL_ROWS

BUCKETS = 1024
_FINITE = 1.7976931348623157e308
_TINY = 5e-324


def numeric_long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, value) with one row per cell that is neither null nor NaN."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "feature", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    method: str = "exact",
    local_rows: int = LOCAL_ROWS,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(by..., feature, n, edges, extra...) where ``edges`` holds the linearly interpolated quantiles in ``probs`` order.

    ``extra`` are further aggregates of ``value`` by name, which take no pass of their own.
    The input is read more than once; pass a written table when computing it is expensive. ``method="approx"``
    trades exactness for a single pass with a bounded sketch.
    """
    # The group as one struct: a struct with nulls equals another one, so a null group is a group in joins too.
    long = numeric_long(df.withColumn("_by", F.struct(*by)) if by else df, columns, ["_by"] if by else [])
    found = _quantiles(long, ["_by", "feature"] if by else ["feature"], probs, method, local_rows, dict(extra or {}))
    return found.select(*[F.col(f"_by.{c}").alias(c) for c in by], "feature", "n", "edges", *(extra or ()))


def _quantiles(
    long: DataFrame, keys: list[str], probs: Sequence[float], method: str, local_rows: int, extra: dict[str, Column]
) -> DataFrame:
    more = [c.alias(name) for name, c in extra.items()]
    n = F.count(F.lit(1)).alias("n")
    if method == "approx":
        sketch = F.percentile_approx("value", [float(p) for p in probs], 10_000)
        return long.groupBy(*keys).agg(n, sketch.alias("edges"), *more)
    if method != "exact":
        raise ValueError("method must be 'exact' or 'approx'")

    sizes = long.groupBy(*keys).agg(n, F.min("value").alias("lo"), F.max("value").alias("hi"), *more)
    large = sizes.where(F.col("n") > local_rows)
    direct = F.percentile("value", F.array(*[F.lit(float(p)) for p in probs])).alias("edges")
    if large.isEmpty():
        return long.groupBy(*keys).agg(n, direct, *more)
    large = materialize(large, "large-groups")
    rest = join_small(long, large.select(*keys), keys, "left_anti").groupBy(*keys).agg(n, direct, *more)
    narrowed = _narrowed(long, large, keys, probs, local_rows).join(large.select(*keys, *extra), keys)
    return rest.unionByName(narrowed)


def _positions(probs: Sequence[float]) -> list[Column]:
    return [F.lit(float(p)) * (F.col("n") - 1) for p in probs]


def _log_scale(value: Column) -> Column:
    """A non-decreasing image of all doubles that spreads every order of magnitude evenly."""
    size = F.log(F.greatest(F.abs(value), F.lit(_TINY))) - F.log(F.lit(_TINY)) + 1
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0.0)


def _bucket(value: Column, lo: Column, hi: Column, log_scale: bool) -> Column:
    """A bucket number that never decreases with the value; both ends have a bucket of their own."""

    def image(c: Column) -> Column:
        finite = F.greatest(F.least(c, F.lit(_FINITE)), F.lit(-_FINITE))
        return _log_scale(finite) if log_scale else finite / 2

    share = F.coalesce(F.try_divide(image(value) - image(lo), image(hi) - image(lo)), F.lit(0.0))
    inner = F.least(1 + F.floor(share * (BUCKETS - 2)), F.lit(BUCKETS - 2))
    return F.when(value == lo, 0).when(value == hi, BUCKETS - 1).otherwise(inner)


def _narrowed(
    long: DataFrame, large: DataFrame, keys: list[str], probs: Sequence[float], local_rows: int
) -> DataFrame:
    wanted = F.array_distinct(
        F.array(*[f(pos).cast("long") for pos in _positions(probs) for f in (F.floor, F.ceil)])
    )
    state = materialize(
        large.select(
            *keys, "n", F.explode(wanted).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"),
            F.col("n").alias("size"),
        ),
        "brackets",
    )
    wide = (F.col("lo") < F.col("hi")) & (F.col("size") > local_rows)
    log_scale = False
    while not state.where(wide).isEmpty():
        open_, done = state.where(wide), state.where(~wide)
        inside = _inside(long, open_, keys)
        bucket = _bucket(F.col("value"), F.col("lo"), F.col("hi"), log_scale)
        cells = inside.groupBy(*keys, "lo", "hi", bucket.alias("bucket")).agg(
            F.count(F.lit(1)).alias("cell"), F.min("value").alias("cell_lo"), F.max("value").alias("cell_hi")
        )
        state = materialize(done.unionByName(_choose(open_, cells, keys, "bucket")), "brackets")
        # Linear buckets are best within one order of magnitude, logarithmic ones across many.
        log_scale = not log_scale
    open_, done = state.where(F.col("lo") < F.col("hi")), state.where(F.col("lo") == F.col("hi"))
    cells = _inside(long, open_, keys).groupBy(*keys, "lo", "hi", "value").agg(F.count(F.lit(1)).alias("cell"))
    cells = cells.withColumns({"cell_lo": F.col("value"), "cell_hi": F.col("value")})
    found = done.unionByName(_choose(open_, cells, keys, "value"))
    ranks = found.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("at"))
    return ranks.select(*keys, "n", F.array(*[_interpolate(pos) for pos in _positions(probs)]).alias("edges"))


def _inside(long: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    spans = brackets.select(*keys, "lo", "hi").distinct()
    return join_small(long, spans, keys).where(F.col("value").between(F.col("lo"), F.col("hi")))


def _choose(brackets: DataFrame, cells: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Move each bracket to the cell that holds its rank; at most ``BUCKETS`` or ``local_rows`` cells per window."""
    span = Window.partitionBy(*keys, "lo", "hi").orderBy(order)
    upto = F.sum("cell").over(span.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumn("upto", upto)
    hit = brackets.join(cells, [*keys, "lo", "hi"]).where(
        (F.col("rank") - F.col("below") < F.col("upto"))
        & (F.col("rank") - F.col("below") >= F.col("upto") - F.col("cell"))
    )
    return hit.select(
        *keys, "n", "rank", F.col("cell_lo").alias("lo"), F.col("cell_hi").alias("hi"),
        (F.col("below") + F.col("upto") - F.col("cell")).alias("below"), F.col("cell").alias("size"),
    )


def _interpolate(pos: Column) -> Column:
    low, high = F.floor(pos), F.ceil(pos)
    at = lambda r: F.element_at("at", r.cast("long"))
    return F.when(at(low) == at(high), at(low)).otherwise((high - pos) * at(low) + (pos - low) * at(high))


def checked_edges(edges: Sequence[float], feature: str, duplicates: str = "raise") -> list[float]:
    """Edges that can delimit bins: repeated ones are an error or are dropped."""
    unique = sorted(set(edges))
    if any(math.isnan(e) for e in edges):
        raise ValueError(f"{feature}: edges are not numbers")
    if len(unique) < len(edges) and duplicates == "raise":
        raise ValueError(f"{feature}: bin edges must be unique, got {list(edges)}; pass duplicates='drop'")
    return unique
