"""Label values: normalisation, mapping to classes, error rows, and the gate before training."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import ERROR, LABEL_TO_CLASS, LABELS


def strip_lower(text: Column) -> Column:
    """Lower case without leading and trailing white space of any kind (``trim`` removes spaces only)."""
    return F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))


def normalise_label(text: Column, allowed: Sequence[str] = LABELS, fallback: str = ERROR) -> Column:
    """The allowed label a text stands for, or ``fallback``."""
    label = strip_lower(text)
    return F.when(label.isin(*allowed), label).otherwise(F.lit(fallback))


def map_values(column: Column, mapping: Mapping[str, int] = LABEL_TO_CLASS) -> Column:
    """Mapped value; anything unmapped becomes null."""
    expr = F.when(F.lit(False), F.lit(None).cast("int"))
    for source, value in mapping.items():
        expr = expr.when(column == source, F.lit(value))
    return expr


def is_error(column: Column) -> Column:
    """The sentinel itself or the sentinel followed by a message."""
    return (column == ERROR) | column.startswith(f"{ERROR}:")


def status_of(column: Column) -> Column:
    return F.when(column.isNull(), F.lit("missing")).when(is_error(column), F.lit("error")).otherwise(F.lit("ok"))


def training_gate(
    df: DataFrame, target: str = "target", on_error: str = "drop"
) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine): rows with an allowed label, carrying ``label``, and the rest.

    ``on_error="fail"`` refuses to go on when any row would be set aside.
    """
    mapped = df.withColumn("label", map_values(F.col(target)))
    clean = mapped.where(F.col("label").isNotNull())
    quarantine = mapped.where(F.col("label").isNull()).drop("label")
    if on_error == "fail" and not quarantine.isEmpty():
        raise ValueError(f"rows without an allowed {target}: repair them or pass on_error='drop'")
    return clean, quarantine


def run_counters(df: DataFrame, result: str, allowed: Sequence[str] | None = None) -> DataFrame:
    """One row (n_rows, n_errors, n_unexpected) for a finished annotation."""
    error = F.coalesce(is_error(F.col(result)), F.lit(True))
    unexpected = ~error & ~F.col(result).isin(*allowed) if allowed else F.lit(False)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(error).alias("n_errors"),
        F.count_if(unexpected).alias("n_unexpected"),
    )
