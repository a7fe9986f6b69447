"""Exact classification metrics over predictions of any size.

Every function takes an optional ``weight`` column of whole row counts, so merged rows give the same figures.
Curves are computed on distinct scores, ordered by ranges (see ``ordering``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .ordering import LOCAL_ROWS, ordered


def _weight(weight: str | None) -> Column:
    return F.col(weight).cast("long") if weight else F.lit(1).cast("long")


def _given(df: DataFrame, column: str) -> Column:
    """The column, where a null or NaN fails the job instead of dropping out of the figures unseen."""
    value, kind = F.col(column), df.schema[column].dataType
    bad = value.isNull() | F.isnan(value) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else value.isNull()
    return F.when(bad, F.raise_error(F.lit(f"{column} has rows without a value")).cast(kind)).otherwise(value)


def _binary(df: DataFrame, column: str) -> Column:
    """The column, where anything but 0 and 1 fails the job."""
    value = _given(df, column)
    wrong = F.concat(F.lit(f"{column} must be 0 or 1, got "), F.col(column).cast("string"))
    return F.when(value.isin(0, 1), value).otherwise(F.raise_error(wrong).cast(df.schema[column].dataType))


def confusion(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", weight: str | None = None) -> DataFrame:
    """(y_true, y_pred, n) for every pair of observed labels, zeros included; a null label is an error."""
    counts = df.groupBy(_given(df, y_true).alias("y_true"), _given(df, y_pred).alias("y_pred")).agg(
        F.sum(_weight(weight)).alias("n")
    )
    # From here on there is at most one row per pair of labels, so they fit in one row.
    pairs = F.map_from_entries(F.collect_list(F.struct(F.struct("y_true", "y_pred"), "n")))
    labels = F.array_distinct(F.concat(F.collect_set("y_true"), F.collect_set("y_pred")))
    grid = counts.agg(pairs.alias("pairs"), labels.alias("labels"))
    grid = grid.select("*", F.explode("labels").alias("y_true"))
    grid = grid.select("pairs", "y_true", F.explode("labels").alias("y_pred"))
    found = F.try_element_at("pairs", F.struct("y_true", "y_pred"))
    return grid.select("y_true", "y_pred", F.coalesce(found, F.lit(0)).alias("n"))


def class_scores(confusion_counts: DataFrame) -> DataFrame:
    """(label, precision, recall, f1_score, support, tp) per class; an empty denominator gives 0."""
    none = F.lit(0).cast("long")
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(none)

    def side(label: str, support: Column, predicted: Column, tp: Column) -> Column:
        return F.struct(F.col(label).alias("label"), support.alias("s"), predicted.alias("p"), tp.alias("h"))

    sides = F.array(side("y_true", F.col("n"), none, hit), side("y_pred", none, F.col("n"), none))
    totals = confusion_counts.select(F.inline(sides)).groupBy("label").agg(
        F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("h").alias("tp")
    )
    tp = F.col("tp").cast("double")
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b.cast("double")), F.lit(0.0))
    return totals.select(
        "label",
        ratio(tp, F.col("predicted")).alias("precision"),
        ratio(tp, F.col("support")).alias("recall"),
        ratio(2 * tp, F.col("support") + F.col("predicted")).alias("f1_score"),
        "support",
        "tp",
    )


def classification_report(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", weight: str | None = None
) -> DataFrame:
    """(label, metric, value): per class, accuracy, macro and weighted averages."""
    names = ("precision", "recall", "f1_score")
    scores = class_scores(confusion(df, y_true, y_pred, weight))
    support = F.sum("support").cast("double")

    def line(label: Column, values: dict[str, Column]) -> Column:
        cells = [
            F.struct(label.alias("label"), F.lit(m).alias("metric"), v.cast("double").alias("value"))
            for m, v in values.items()
        ]
        return F.array(*cells)

    per_class = line(F.col("label").cast("string"), {m: F.col(m) for m in (*names, "support")})
    averages = {
        "macro avg": {m: F.avg(m) for m in names},
        "weighted avg": {m: F.sum(F.col(m) * F.col("support")) / support for m in names},
    }
    # One row per class goes in, so everything fits in one row of cells.
    cells = scores.agg(
        F.concat(
            F.flatten(F.collect_list(per_class)),
            line(F.lit("accuracy"), {"accuracy": F.sum("tp").cast("double") / support}),
            *[line(F.lit(label), {**v, "support": support}) for label, v in averages.items()],
        ).alias("cells")
    )
    return cells.select(F.inline("cells"))


def _by_score(df: DataFrame, y_true: str, score: str, weight: str | None) -> DataFrame:
    w, positive = _weight(weight), _binary(df, y_true) == 1
    return df.groupBy(_given(df, score).cast("double").alias("score")).agg(
        F.sum(F.when(positive, w).otherwise(0)).alias("pos"), F.sum(F.when(positive, 0).otherwise(w)).alias("neg"),
    )


def roc_auc(
    df: DataFrame, y_true: str = "y_true", score: str = "y_prob", weight: str | None = None,
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """One row (n_pos, n_neg, auc): the share of (positive, negative) pairs in the right order, ties counting half."""
    table = ordered(_by_score(df, y_true, score, weight), ["score"], local_rows=local_rows)
    rows = table.scan(sums={"upto": "neg"})
    # Pair counts pass 2^63 on large tables, so they are summed as decimals.
    wide = lambda c: c.cast("decimal(19,0)")
    pairs = wide(F.col("pos")) * wide(2 * F.col("upto") - F.col("neg"))
    total = rows.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(pairs).alias("twice"))
    auc = F.try_divide(
        F.col("twice").cast("double"), F.lit(2.0) * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    )
    return total.select("n_pos", "n_neg", auc.alias("auc"))


def roc_curve(
    df: DataFrame, y_true: str = "y_true", score: str = "y_prob", weight: str | None = None,
    drop_intermediate: bool = True, local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """(threshold, fpr, tpr) from the (0, 0) corner, whose threshold is infinite, to (1, 1).

    ``drop_intermediate`` leaves out points on a straight line between their neighbours.
    """
    table = ordered(_by_score(df, y_true, score, weight), ["score"], descending=True, local_rows=local_rows)
    rows = table.scan(
        sums={"fp": "neg", "tp": "pos"},
        before={"prev_score": "score"},
        after={"next_pos": "pos", "next_neg": "neg"},
    )
    totals = table.df.agg(F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n"))
    p, n = totals.select("p").scalar(), totals.select("n").scalar()
    if drop_intermediate:
        straight = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
        end = F.col("prev_score").isNull() | F.col("next_pos").isNull()
        rows = rows.where(end | ~straight)
    points = rows.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), n).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), p).alias("tpr"),
    )
    corner = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return corner.unionByName(points)


def curve_area(
    curve: DataFrame, x: str = "fpr", y: str = "tpr", local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """One row (area): trapezoid rule over the points of a non-decreasing curve."""
    points = curve.select(F.col(x).alias("x"), F.col(y).alias("y")).distinct()
    rows = ordered(points, ["x", "y"], local_rows=local_rows).scan(before={"x0": "x", "y0": "y"})
    return rows.agg(F.sum((F.col("x") - F.col("x0")) * (F.col("y") + F.col("y0")) / 2).alias("area"))
