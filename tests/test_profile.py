import numpy as np
import pandas as pd
import pytest

from riskspark.operators import distribution, profile


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(9)
    n = 400
    frame = pd.DataFrame(
        {
            "id": range(n),
            "age": rng.integers(19, 75, n),
            "amount": np.round(rng.lognormal(7, 1, n), 2),
            "housing": rng.choice(["own", "rent", None], n, p=[0.6, 0.3, 0.1]),
            "target": rng.choice(["good risk", "bad risk"], n, p=[0.7, 0.3]),
        }
    )
    return frame, spark.createDataFrame(frame)


@pytest.mark.parametrize("local_rows", [60, 1_000_000])
def test_describe(people, local_rows):
    frame, df = people
    got = profile.describe_numeric(df, ["age", "amount"], local_rows=local_rows).toPandas().set_index("feature")
    want = frame[["age", "amount"]].describe().T
    want.columns = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    np.testing.assert_allclose(got.loc[want.index, want.columns].astype(float), want, rtol=1e-10)


def test_describe_small_values_and_empty_column(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None), (4, None)], "x int, y double")
    got = {r.feature: r for r in profile.describe_numeric(df, ["x", "y"]).collect()}
    assert (got["x"].p50, got["x"].p75) == (1.5, 2.5)
    assert got["y"]["count"] == 0 and got["y"].p50 is None


def test_info_nulls_and_counts(people):
    frame, df = people
    info = {r.feature: (r.dtype, r.n_rows, r.n_non_null) for r in profile.frame_info(df).collect()}
    assert info["housing"] == ("string", 400, int(frame.housing.notna().sum()))
    nulls = {r.feature: r.n_null for r in profile.null_counts(df).collect()}
    assert nulls["housing"] == int(frame.housing.isna().sum()) and nulls["age"] == 0
    counts = {r.value: r.n for r in profile.value_counts(df, ["housing"]).collect()}
    want = frame.housing.value_counts(dropna=False)
    assert counts == {None if pd.isna(k) else k: v for k, v in want.items()}
    share = {r.value: r.proportion for r in profile.value_share(df, "housing").collect()}
    assert share == pytest.approx(frame.housing.value_counts(normalize=True).to_dict())


def test_frequency_order(people):
    rows = profile.by_frequency(profile.value_counts(people[1], ["housing", "target"])).collect()
    for feature in ("housing", "target"):
        n = [r.n for r in rows if r.feature == feature]
        assert n == sorted(n, reverse=True)


def test_histogram_matches_numpy(people, spark):
    frame, df = people
    for c in ("age", "amount"):
        counts, edges = np.histogram(frame[c], bins=20)
        rows = profile.histogram(df, c, 20).orderBy("bin").collect()
        assert [r.n for r in rows] == list(counts)
        np.testing.assert_allclose([r.lo for r in rows] + [rows[-1].hi], edges, rtol=1e-12)
    one = profile.histogram(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r.n for r in one] == list(np.histogram([5.0, 5.0], bins=4)[0])


def test_density(people):
    frame, df = people
    x = frame["amount"].to_numpy()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    dense = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    rows = profile.kde(df, "amount").orderBy("point").collect()
    np.testing.assert_allclose([r.x for r in rows], grid)
    np.testing.assert_allclose([r.y for r in rows], dense * len(x) * (x.max() - x.min()) / 20, rtol=1e-9)


@pytest.mark.parametrize("local_rows", [40, 1_000_000])
def test_box_stats_and_outliers(people, local_rows):
    frame, df = people
    stats = {r.target: r for r in profile.box_stats(df, "target", ["amount"], local_rows=local_rows).collect()}
    outliers = profile.box_outliers(df, "id", "target", ["amount"], local_rows=local_rows).toPandas()
    for target, part in frame.groupby("target"):
        q1, med, q3 = part.amount.quantile([0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = part.amount[part.amount.between(low, high)]
        r = stats[target]
        np.testing.assert_allclose([r.q1, r.med, r.q3, r.whislo, r.whishi], [q1, med, q3, inside.min(), inside.max()])
        assert r.n_outliers == len(part) - len(inside)
        assert set(outliers[outliers.target == target]["id"]) == set(part[~part.amount.between(low, high)]["id"])


def test_conditional_distribution(people):
    frame, df = people
    got = {(r.feature, r.value, r.target): r.share for r in
           distribution.conditional_distribution(df.drop("id"), "target", ["housing", "age"]).collect()}
    want = frame.groupby("housing")["target"].value_counts(normalize=True)
    assert {k[1:]: v for k, v in got.items() if k[0] == "housing"} == pytest.approx(want.to_dict())
    for value in {k[1] for k in got if k[0] == "age"}:
        assert sum(v for k, v in got.items() if k[:2] == ("age", value)) == pytest.approx(1)
    kept = distribution.conditional_distribution(df, "target", ["housing"], dropna=False).where("value is null")
    assert kept.agg({"n": "sum"}).first()[0] == int(frame.housing.isna().sum())
    default = distribution.conditional_distribution(df.withColumnRenamed("housing", "description"), "target")
    assert {r.feature for r in default.select("feature").distinct().collect()} == {"id", "age", "amount"}


def test_named_classes_give_the_same_rows_and_refuse_others(people):
    _, df = people
    rows = lambda d: sorted(map(tuple, d.collect()))
    columns = ["housing", "age"]
    named = distribution.conditional_distribution(df, "target", columns, classes=["good risk", "bad risk"])
    assert rows(named) == rows(distribution.conditional_distribution(df, "target", columns))
    with pytest.raises(Exception, match="unknown target"):
        distribution.conditional_distribution(df, "target", columns, classes=["good risk"]).collect()
