"""Quantile bins: a fitted model with frozen edges, and bins computed per group of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from ..schema import QUARTILES
from .joins import join_small
from .ordering import LOCAL_ROWS
from .quantiles import checked_edges, exact_quantiles


def bin_expr(value: Column, inner: Sequence[float | Column], labels: Sequence[str | int]) -> Column:
    """Right-closed bins over the inner edges; the outer bins are open, so any number gets a label.

    Without edges there is no bin: a null edge gives a null label.
    """
    none = value.isNull() | F.isnan(value.cast("double"))
    for edge in inner:
        none = none | edge.isNull() if isinstance(edge, Column) else none
    expr = F.when(none, None)
    for edge, label in zip(inner, labels):
        expr = expr.when(value <= edge, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


class _BinParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "numeric columns to bin", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "bin label columns", TypeConverters.toListString)
    labels = Param(Params._dummy(), "labels", "per column, labels from the lowest bin up", TypeConverters.toList)
    probs = Param(Params._dummy(), "probs", "quantile probabilities of the edges", TypeConverters.toListFloat)
    duplicates = Param(Params._dummy(), "duplicates", "'raise' or 'drop' repeated edges", TypeConverters.toString)
    method = Param(Params._dummy(), "method", "'exact' or 'approx' quantiles", TypeConverters.toString)

    def _labels_for(self, i: int, bins: int) -> list:
        labels = self.getOrDefault(self.labels)[i] if self.isDefined(self.labels) else None
        if labels is None:
            return list(range(bins))
        if len(labels) != bins:
            raise ValueError(f"{self.getOrDefault(self.inputCols)[i]}: {bins} bins but {len(labels)} labels")
        return list(labels)


class QuantileBinner(Estimator, _BinParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns quantile edges from the fitted rows; scoring never recomputes them."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labels=None, probs=None, duplicates="raise", method="exact"):
        super().__init__()
        self._setDefault(probs=list(QUARTILES), duplicates="raise", method="exact")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "QuantileBinnerModel":
        columns = self.getOrDefault(self.inputCols)
        found = exact_quantiles(
            dataset, columns, self.getOrDefault(self.probs), method=self.getOrDefault(self.method)
        )
        # One row of edges per binned column.
        by_column = {r.feature: r.edges for r in found.collect()}
        edges = []
        for i, c in enumerate(columns):
            if c not in by_column:
                raise ValueError(f"{c}: no values to bin")
            edges.append(checked_edges(by_column[c], c, self.getOrDefault(self.duplicates)))
            self._labels_for(i, len(edges[-1]) - 1)
        model = QuantileBinnerModel()
        for param in self.params:
            if self.isSet(param):
                model._set(**{param.name: self.getOrDefault(param)})
        return model._set(edges=edges)


class QuantileBinnerModel(Model, _BinParams, DefaultParamsReadable, DefaultParamsWritable):
    edges = Param(Params._dummy(), "edges", "per column, ascending bin edges", TypeConverters.toList)

    def __init__(self):
        super().__init__()
        self._setDefault(probs=list(QUARTILES), duplicates="raise", method="exact")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols))
        bins = {}
        for i, (source, name) in enumerate(names):
            edges = self.getOrDefault(self.edges)[i]
            bins[name] = bin_expr(F.col(source), edges[1:-1], self._labels_for(i, len(edges) - 1))
        return dataset.withColumns(bins)


def bin_by_group(
    df: DataFrame, by: Sequence[str], columns: dict[str, str], labels: dict[str, Sequence[str]],
    duplicates: str = "raise", local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """Bins with edges recomputed inside each group (the behaviour of binning one request at a time).

    Groups of any size are exact; the edges are joined back as one row per group, a null group being one as well.
    Labels go to the four quarters by position: with ``duplicates="keep"`` a quarter between repeated edges stays empty
    and its label unused. Bins without labels, where repeated edges can be dropped, are those of ``QuantileBinner``.
    """
    if duplicates not in ("raise", "keep"):
        raise ValueError("duplicates must be 'raise' or 'keep'")
    probs = [i / 4 for i in range(5)]
    found = exact_quantiles(df, list(columns), probs, by=by, local_rows=local_rows)
    edges = found.groupBy(F.struct(*by).alias("_by")).pivot("feature", list(columns)).agg(F.first("edges"))
    if duplicates == "raise":
        repeated = [F.size(F.array_distinct(c)) < F.size(c) for c in columns]
        bad = edges.where(F.array_contains(F.array(*repeated), True)).take(1)
        if bad:
            raise ValueError(f"bin edges must be unique, got {bad[0].asDict()}; pass duplicates='keep'")
    edges = edges.select("_by", *[F.col(c).alias(f"_edges_{c}") for c in columns])
    out = join_small(df.withColumn("_by", F.struct(*by)), edges, ["_by"], "left")
    bins = {
        name: bin_expr(F.col(c), [F.col(f"_edges_{c}")[i] for i in (1, 2, 3)], labels[c])
        for c, name in columns.items()
    }
    return out.withColumns(bins).drop("_by", *[f"_edges_{c}" for c in columns])


def _shown(edge: float, precision: int) -> float:
    """Rounded to so many decimals, and below one to so many digits that count."""
    return float(round(edge, precision)) if abs(edge) >= 1 or edge == 0 else float(f"{edge:.{precision}g}")


def bin_intervals(df: DataFrame, column: str, labels: Sequence[str], precision: int = 3) -> DataFrame:
    """(ordinal, label, lo, hi, lo_inclusive): the displayed ranges; the first starts just below the minimum.

    Repeated edges are an error. Edges that only rounding makes equal are shown with more digits.
    """
    found = exact_quantiles(df, [column], QUARTILES).first()  # one row of five numbers
    if found is None:
        raise ValueError(f"{column}: no values to bin")
    edges = checked_edges(found["edges"], column)
    while len({_shown(e, precision) for e in edges}) < len(edges) and precision < 20:
        precision += 1
    edges = df.sparkSession.range(1).select(F.array(*[F.lit(_shown(e, precision)) for e in edges]).alias("edges"))
    rows = edges.select(
        F.posexplode(F.slice("edges", 1, F.size("edges") - 1)).alias("ordinal", "lo"), F.col("edges").alias("all")
    )
    first = F.col("ordinal") == 0
    return rows.select(
        "ordinal",
        F.array(*[F.lit(x) for x in labels])[F.col("ordinal")].alias("label"),
        F.when(first, F.round(F.col("lo") - 10.0**-precision, precision + 15)).otherwise(F.col("lo")).alias("lo"),
        F.col("all")[F.col("ordinal") + 1].alias("hi"),
        F.lit(False).alias("lo_inclusive"),
    )
