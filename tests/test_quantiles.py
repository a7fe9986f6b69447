import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.operators import quantiles
from riskspark.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)


def edges(df, columns, by=(), **options):
    return {
        (*[r[b] for b in by], r.feature): list(r.edges)
        for r in exact_quantiles(df, columns, PROBS, by=by, **options).collect()
    }


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 0 holds most rows; values span many magnitudes, repeat heavily, and include nulls and NaN."""
    rng = np.random.default_rng(3)
    n = 6000
    frame = pd.DataFrame(
        {
            "g": np.where(rng.random(n) < 0.7, 0, rng.integers(1, 9, n)),
            "heavy": np.where(rng.random(n) < 0.4, 7.0, np.round(rng.normal(0, 50, n), 2)),
            "wide": np.exp(rng.normal(0, 40, n)) * np.where(rng.random(n) < 0.5, -1, 1),
            "same": 3.0,
        }
    )
    frame.loc[::50, "heavy"] = np.nan
    df = spark.createDataFrame(frame)
    return frame, df.withColumn("heavy", F.when(F.col("g") < 5, F.col("heavy")).when(~F.isnan("heavy"), F.col("heavy")))


@pytest.mark.parametrize("local_rows", [10, 300, 1_000_000])
def test_matches_numpy(skewed, local_rows):
    frame, df = skewed
    got = edges(df, ["heavy", "wide", "same"], local_rows=local_rows)
    for c in ("heavy", "wide", "same"):
        want = np.quantile(frame[c].dropna(), PROBS)
        np.testing.assert_allclose(got[(c,)], want, rtol=1e-12)


@pytest.mark.parametrize("local_rows", [10, 300])
def test_large_and_small_groups(skewed, local_rows):
    frame, df = skewed
    got = edges(df, ["heavy", "wide"], by=["g"], local_rows=local_rows)
    for g, part in frame.groupby("g"):
        for c in ("heavy", "wide"):
            np.testing.assert_allclose(got[(g, c)], np.quantile(part[c].dropna(), PROBS), rtol=1e-12)


def test_infinite_values(spark):
    values = [float("-inf")] * 3 + [float(i) for i in range(40)] + [float("inf")] * 3
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = edges(df, ["x"], local_rows=5)[("x",)]
    assert got[0] == float("-inf") and got[-1] == float("inf") and got[2] == 19.5


def test_counts_and_approx(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    exact = exact_quantiles(df, ["x"], (0.5,), local_rows=100).first()
    rough = exact_quantiles(df, ["x"], (0.5,), method="approx").first()
    assert (exact.n, exact.edges) == (1000, [500.5]) and abs(rough.edges[0] - 500.5) < 2
    with pytest.raises(ValueError):
        exact_quantiles(df, ["x"], (0.5,), method="other")


def test_repeated_edges():
    with pytest.raises(ValueError, match="unique"):
        quantiles.checked_edges([1, 1, 2], "x")
    assert quantiles.checked_edges([1, 1, 2], "x", "drop") == [1, 2]
