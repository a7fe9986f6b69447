"""Running sums and neighbours in a total order, without sending the table through one task.

A plain ``Window.orderBy`` moves every row into one partition. Here the table is range-partitioned by the order, each
part is scanned on its own, and one summary row per part carries totals and edge rows over to the next parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .joins import join_small

LOCAL_ROWS = 1_000_000
#: Tasks that write the ranges, where there are more ranges: so many, or one for so many rows.
TASKS, TASK_ROWS = 32, 100_000


@dataclass(frozen=True)
class OrderedTable:
    """A written table whose ``_part`` column numbers contiguous ranges of the order; the order must be unique."""

    df: DataFrame
    order: tuple[str, ...]
    descending: bool
    parts: int

    def _sort(self) -> list[Column]:
        return [F.col(c).desc() if self.descending else F.col(c).asc() for c in self.order]

    def scan(
        self,
        sums: Mapping[str, str] | None = None,
        before: Mapping[str, str] | None = None,
        after: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Add running sums (current row included) and values of the previous/next row, as ``{new: source}``."""
        sums, before, after = dict(sums or {}), dict(before or {}), dict(after or {})
        local = Window.partitionBy("_part").orderBy(*self._sort())
        up_to = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = self.df.select(
            "*",
            *[F.sum(src).over(up_to).alias(new) for new, src in sums.items()],
            *[F.lag(src).over(local).alias(new) for new, src in before.items()],
            *[F.lead(src).over(local).alias(new) for new, src in after.items()],
            F.row_number().over(local).alias("_pos"),
        )
        if self.parts > 1:
            out = self._carry(out, sums, before, after)
        return out.drop("_part", "_pos", "_len")

    def _carry(self, out: DataFrame, sums, before, after) -> DataFrame:
        rank = F.struct(*self.order)
        first_of, last_of = (F.max_by, F.min_by) if self.descending else (F.min_by, F.max_by)
        fields = sorted({*before.values(), *after.values()})
        edge = F.struct(*fields) if fields else F.struct(F.lit(0).alias("_none"))
        summary = self.df.groupBy("_part").agg(
            F.count(F.lit(1)).alias("_len"),
            *[F.sum(src).alias(f"_sum_{new}") for new, src in sums.items()],
            first_of(edge, rank).alias("_first"),
            last_of(edge, rank).alias("_last"),
        )
        # One row per part, so this window is small by construction.
        over = Window.orderBy("_part")
        earlier = over.rowsBetween(Window.unboundedPreceding, -1)
        summary = summary.select(
            "_part",
            "_len",
            *[F.coalesce(F.sum(f"_sum_{new}").over(earlier), F.lit(0)).alias(f"_base_{new}") for new in sums],
            F.lag("_last").over(over).alias("_prev"),
            F.lead("_first").over(over).alias("_next"),
        )
        out = join_small(out, summary, ["_part"])
        changed = {new: F.col(new) + F.col(f"_base_{new}") for new in sums}
        for new, src in before.items():
            changed[new] = F.when(F.col("_pos") == 1, F.col(f"_prev.{src}")).otherwise(F.col(new))
        for new, src in after.items():
            changed[new] = F.when(F.col("_pos") == F.col("_len"), F.col(f"_next.{src}")).otherwise(F.col(new))
        return out.withColumns(changed).drop("_prev", "_next", *[f"_base_{new}" for new in sums])


def ordered(
    df: DataFrame, order: Sequence[str], descending: bool = False, local_rows: int = LOCAL_ROWS
) -> OrderedTable:
    """Write ``df`` and split it into ranges of about ``local_rows`` rows; a small table stays one range.

    Ranges that are small and many do not get a task and a file each: a task sorts its rows and cuts them into ranges.
    """
    table = materialize(df, "ordered")
    rows = table.count()
    parts = max(1, -(-rows // local_rows))
    if parts == 1:
        return OrderedTable(table.withColumn("_part", F.lit(0)), tuple(order), descending, 1)
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    tasks = min(parts, max(TASKS, -(-rows // TASK_ROWS)))
    ranged = table.repartitionByRange(tasks, *sort)
    if tasks == parts:
        ranged = ranged.withColumn("_part", F.spark_partition_id())
    else:
        # Within a task the numbers follow each other; a range is named by the number of its first row.
        numbered = ranged.sortWithinPartitions(*sort).withColumn("_part", F.monotonically_increasing_id())
        ranged = numbered.withColumn("_part", F.col("_part") - F.col("_part").bitwiseAND((1 << 33) - 1) % local_rows)
    return OrderedTable(materialize(ranged, "ranged"), tuple(order), descending, parts)
