import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskspark.operators import curvature
from riskspark.plans import training
from riskspark.session import materialize


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    a, b, n = rng.integers(0, 3, 60), rng.integers(0, 4, 60), rng.integers(1, 9, 60)
    x = np.zeros((60, 8))
    x[np.arange(60), a] = 1
    x[np.arange(60), 3 + b] = 1
    x[:, 7] = rng.normal(size=60)
    y = (rng.random(60) < 1 / (1 + np.exp(-(a - 1 + x[:, 7])))).astype(int)
    return x, y, n


@pytest.fixture(scope="module")
def merged(spark, rows):
    x, y, n = rows
    made = spark.createDataFrame([(x[i].tolist(), int(y[i]), int(n[i])) for i in range(60)], "x array<double>, label int, n bigint")
    return materialize(made.select(array_to_vector("x").alias("features"), "label", "n"), "merged")


def plain(rows, beta):
    x, y, n = rows
    x = np.c_[x, np.ones(len(x))]
    p = 1 / (1 + np.exp(-x @ beta))
    return x.T @ (x * (n * p * (1 - p))[:, None]), x.T @ (n * (y - p)), -(n * np.where(y == 1, np.log(p), np.log(1 - p))).sum()


def test_sums_equal_the_matrix_products(merged, rows):
    beta = np.linspace(-1, 1, 9)
    curve, slope, loss = plain(rows, beta)
    got = {(r.i, r.j): r.value for r in curvature.curvature_sums(merged, beta).collect()}
    assert got.pop((curvature.LOSS, curvature.LOSS)) == pytest.approx(loss)
    for i in range(9):
        assert got.pop((i, curvature.GRADIENT)) == pytest.approx(slope[i])
    assert all(i <= j for i, j in got)
    for (i, j), value in got.items():
        assert value == pytest.approx(curve[i, j])
    assert (0, 1) not in got and curve[0, 1] == 0  # cells that are never together send nothing


def test_coefficients_equal_the_present_fit_and_errors_the_inverse(merged, rows):
    fit = curvature.newton_logistic(merged, 8)
    present = training.fit_logistic(merged, balance=False)
    assert fit.coefficients == pytest.approx(np.r_[present.coefficients.toArray(), present.intercept], abs=1e-4)
    curve, slope, loss = plain(rows, fit.coefficients)
    penalty = np.r_[np.ones(8), 0]
    assert np.abs(slope - penalty * fit.coefficients).max() < 1e-6
    assert fit.errors == pytest.approx(np.sqrt(np.diag(np.linalg.inv(curve + np.diag(penalty)))))
    assert fit.objective == pytest.approx(loss + 0.5 * penalty @ fit.coefficients**2) and 0 < fit.steps < 12


def test_class_weights_and_merging_change_nothing(merged):
    weighted, _ = training.balanced(merged)
    whole = curvature.newton_logistic(weighted, 8, weight="weight")
    present = training.fit_logistic(merged)
    assert whole.coefficients == pytest.approx(np.r_[present.coefficients.toArray(), present.intercept], abs=1e-4)
    apart = merged.withColumn("one", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).withColumn("n", F.lit(1))
    assert curvature.newton_logistic(apart, 8).errors == pytest.approx(curvature.newton_logistic(merged, 8).errors)


def test_a_wide_model_is_refused(merged):
    with pytest.raises(ValueError, match="not gathered"):
        curvature.newton_logistic(merged, 8, max_width=7)
