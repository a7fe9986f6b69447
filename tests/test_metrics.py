import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.operators import metrics

# The confusion counts of a published evaluation, and the figures it states for them.
GOLDEN = [(0, 0, 35), (0, 1, 11), (1, 0, 49), (1, 1, 105)]
FIGURES = {
    ("0", "precision"): 0.4166666666666667, ("0", "recall"): 0.7608695652173914,
    ("0", "f1_score"): 0.5384615384615384, ("0", "support"): 46,
    ("1", "precision"): 0.9051724137931034, ("1", "recall"): 0.6818181818181818,
    ("1", "f1_score"): 0.7777777777777777, ("1", "support"): 154,
    ("accuracy", "accuracy"): 0.7,
    ("macro avg", "precision"): 0.6609195402298851, ("macro avg", "recall"): 0.7213438735177866,
    ("macro avg", "f1_score"): 0.658119658119658, ("macro avg", "support"): 200,
    ("weighted avg", "precision"): 0.7928160919540229, ("weighted avg", "recall"): 0.7,
    ("weighted avg", "f1_score"): 0.7227350427350426, ("weighted avg", "support"): 200,
}


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame(GOLDEN, "y_true int, y_pred int, n int")


def as_dict(report):
    return {(r.label, r.metric): r.value for r in report.collect()}


def test_report_from_counts_and_from_rows(golden):
    rows = golden.select("y_true", "y_pred", F.explode(F.sequence(F.lit(1), "n")))
    for got in (as_dict(metrics.classification_report(golden, weight="n")), as_dict(metrics.classification_report(rows))):
        assert got.keys() == FIGURES.keys()
        assert all(math.isclose(got[k], v, rel_tol=1e-12) for k, v in FIGURES.items())


def test_confusion_keeps_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y_true int, y_pred int")
    got = {(r.y_true, r.y_pred): r.n for r in metrics.confusion(df).collect()}
    assert got == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    report = as_dict(metrics.classification_report(df))
    assert report[("1", "precision")] == 0 and report[("1", "f1_score")] == 0


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 800)
    p = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)
    frame = pd.DataFrame({"y_true": y, "y_prob": p})
    return frame, spark.createDataFrame(frame)


def brute_auc(frame):
    pos = frame.loc[frame.y_true == 1, "y_prob"].to_numpy()[:, None]
    neg = frame.loc[frame.y_true == 0, "y_prob"].to_numpy()[None, :]
    return ((pos > neg) + 0.5 * (pos == neg)).mean()


@pytest.mark.parametrize("local_rows", [7, 1_000_000])
def test_auc_is_exact_and_equals_the_area(scored, local_rows):
    frame, df = scored
    want = brute_auc(frame)
    assert math.isclose(metrics.roc_auc(df, local_rows=local_rows).first().auc, want, rel_tol=1e-12)
    curve = metrics.roc_curve(df, local_rows=local_rows)
    assert math.isclose(metrics.curve_area(curve, local_rows=local_rows).first().area, want, rel_tol=1e-12)


def test_auc_under_monotone_change_and_weights(scored):
    _, df = scored
    base = metrics.roc_auc(df).first().auc
    assert metrics.roc_auc(df.withColumn("y_prob", F.exp("y_prob") * 9)).first().auc == base
    merged = df.groupBy("y_true", "y_prob").agg(F.count(F.lit(1)).alias("n"))
    assert metrics.roc_auc(merged, weight="n").first().auc == base


def test_curve_ranges_agree_and_drop_only_collinear_points(scored):
    _, df = scored
    rows = lambda c: sorted((r.fpr, r.tpr, r.threshold) for r in c.collect())
    assert rows(metrics.roc_curve(df, local_rows=9)) == rows(metrics.roc_curve(df))
    full = rows(metrics.roc_curve(df, drop_intermediate=False))
    slim = rows(metrics.roc_curve(df))
    assert set(slim) <= set(full) and slim[0] == full[0] and slim[-1] == full[-1]
    assert full[0][:2] == (0.0, 0.0) and full[-1][:2] == (1.0, 1.0)


def test_auc_without_a_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y_true int, y_prob double")
    assert metrics.roc_auc(df).first().auc is None


@pytest.mark.parametrize("row", [(None, 1, 0.5), (1, None, 0.5)])
def test_missing_labels_and_predictions_are_an_error(spark, row):
    rows = spark.createDataFrame([(1, 1, 0.1), (0, 1, 0.2), row], "y_true int, y_pred int, y_prob double")
    with pytest.raises(Exception, match="without a value"):
        metrics.classification_report(rows).collect()


@pytest.mark.parametrize("row,message", [
    ((None, 0.5), "without a value"), ((1, None), "without a value"), ((1, float("nan")), "without a value"), ((2, 0.5), "0 or 1"),
])
def test_scores_need_labels_of_0_and_1_and_values(spark, row, message):
    rows = spark.createDataFrame([(1, 0.1), (0, 0.2), row], "y_true int, y_prob double")
    with pytest.raises(Exception, match=message):
        metrics.roc_auc(rows).collect()
    with pytest.raises(Exception, match=message):
        metrics.roc_curve(rows).collect()
