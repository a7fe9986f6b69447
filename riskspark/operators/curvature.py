"""Curvature of the logistic loss over merged rows: Newton steps and standard errors from one aggregation each.

A row adds the products of its non-zero cells, the intercept among them, so its cost goes with their pairs and not with the
square of the vector's width; sums are combined before the shuffle. The driver holds one matrix of the model's width, which
``MAX_WIDTH`` bounds.

Position ``width`` is the intercept. The L2 penalty ``0.5 / c`` times the sum of squares is on all other coefficients, which is
the objective of ``training.fit_logistic``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

#: Widest model whose matrix is gathered: 32 MB of numbers.
MAX_WIDTH = 2000
#: In place of a second position: the gradient; in place of both: the loss.
GRADIENT, LOSS = -1, -2


def curvature_sums(
    merged: DataFrame, beta: np.ndarray, weight: str = "n", features: str = "features", label: str = "label",
) -> DataFrame:
    """(i, j, value) at coefficients ``beta``, the intercept last, without the penalty.

    ``i <= j``: weighted sums of p (1 - p) x_i x_j; j = GRADIENT: of (label - p) x_i; i = j = LOSS: of the log loss.
    """
    width = len(beta) - 1
    known = F.lit([float(b) for b in beta])
    some = F.filter(
        F.transform(vector_to_array(features), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda cell: cell["x"] != 0)
    cells = F.concat(some, F.array(F.struct(F.lit(width).alias("i"), F.lit(1.0).alias("x"))))
    rows = merged.select(F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), cells.alias("cells"))
    margin = F.aggregate("cells", F.lit(0.0), lambda total, cell: total + cell["x"] * F.get(known, cell["i"]))
    rows = rows.withColumn("margin", margin).withColumn("p", 1 / (1 + F.exp(-F.col("margin"))))
    entry = lambda i, j, value: F.struct(i.alias("i"), j.alias("j"), value.alias("value"))
    each = F.col("w") * F.col("p") * (1 - F.col("p"))
    pairs = F.flatten(F.transform("cells", lambda a: F.transform(
        F.filter("cells", lambda b: b["i"] >= a["i"]), lambda b: entry(a["i"], b["i"], each * a["x"] * b["x"]))))
    slopes = F.transform("cells", lambda a: entry(a["i"], F.lit(GRADIENT), F.col("w") * (F.col("y") - F.col("p")) * a["x"]))
    # log(1 + exp(m)) - y m, without overflow
    loss = F.greatest(F.col("margin"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("margin"))) - F.col("y") * F.col("margin")
    whole = F.array(entry(F.lit(LOSS), F.lit(LOSS), F.col("w") * loss))
    return rows.select(F.inline(F.concat(pairs, slopes, whole))).groupBy("i", "j").agg(F.sum("value").alias("value"))


@dataclass(frozen=True)
class NewtonFit:
    """Coefficients and their standard errors, the intercept last; the objective, and the number of steps taken."""

    coefficients: np.ndarray
    errors: np.ndarray
    objective: float
    steps: int


def _state(merged: DataFrame, beta: np.ndarray, penalty: np.ndarray, **columns: str) -> tuple[np.ndarray, np.ndarray, float]:
    size = len(beta)
    curve, slope, loss = np.zeros((size, size)), np.zeros(size), 0.0
    for i, j, value in curvature_sums(merged, beta, **columns).toPandas().itertuples(index=False):
        if j == LOSS:
            loss = value
        elif j == GRADIENT:
            slope[i] = value
        else:
            curve[i, j] = curve[j, i] = value
    return curve + np.diag(penalty), slope - penalty * beta, loss + 0.5 * float(penalty @ beta**2)


def newton_logistic(
    merged: DataFrame, width: int, c: float = 1.0, weight: str = "n", features: str = "features", label: str = "label",
    steps: int = 50, tolerance: float = 1e-9, max_width: int = MAX_WIDTH,
) -> NewtonFit:
    """Logistic regression by Newton steps, halved where a whole one would raise the objective.

    Standard errors are the roots of the diagonal of the inverse curvature, penalty included, at the weights given: with
    ``weight="n"`` those of the rows, with class weights those of the reweighted rows.
    """
    if width > max_width:
        raise ValueError(f"{width} positions; the curvature of more than {max_width} is not gathered")
    columns = {"weight": weight, "features": features, "label": label}
    beta, penalty = np.zeros(width + 1), np.full(width + 1, 1.0 / c)
    penalty[-1] = 0.0
    curve, slope, objective = _state(merged, beta, penalty, **columns)
    taken = 0
    while taken < steps and np.abs(slope).max() > tolerance * max(1.0, abs(objective)):
        move, size = np.linalg.solve(curve, slope), 1.0
        while True:
            new = _state(merged, beta + size * move, penalty, **columns)
            if new[2] <= objective + 1e-12 * abs(objective) or size < 1e-6:
                break
            size /= 2
        beta, (curve, slope, objective), taken = beta + size * move, new, taken + 1
    return NewtonFit(beta, np.sqrt(np.diag(np.linalg.inv(curve))), objective, taken)
