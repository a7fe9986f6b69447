import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel

from riskspark.operators.binning import QuantileBinner, QuantileBinnerModel, bin_by_group, bin_intervals
from riskspark.session import scratch_path

LABELS = ["low", "mid-low", "mid-high", "high"]


def binner(columns, **options):
    return QuantileBinner(
        inputCols=columns, outputCols=[f"{c}_bin" for c in columns], labels=[LABELS] * len(columns), **options
    )


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"id": range(41), "credit": rng.permutation(41) * 37 + 800, "age": rng.permutation(41) + 20})
    return frame, spark.createDataFrame(frame)


def test_edges_and_labels_match_pandas(sample):
    frame, df = sample
    model = binner(["credit", "age"]).fit(df)
    edges = [pd.qcut(frame[c], 4, retbins=True)[1].tolist() for c in ("credit", "age")]
    assert model.getOrDefault("edges") == edges
    got = model.transform(df).toPandas().sort_values("id")
    for c in ("credit", "age"):
        assert list(got[f"{c}_bin"]) == list(pd.qcut(frame[c], 4, labels=LABELS).astype(str))


def test_ordinals_and_right_closed_edges(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 5)], "x int")
    model = QuantileBinner(inputCols=["x"], outputCols=["b"]).fit(df)
    assert [r.b for r in model.transform(df).orderBy("x").collect()] == [0, 0, 1, 2, 3]


def test_repeated_edges_raise_or_drop(spark):
    df = spark.createDataFrame([(x,) for x in (1, 1, 1, 1, 2)], "x int")
    with pytest.raises(ValueError, match="unique"):
        binner(["x"]).fit(df)
    model = QuantileBinner(inputCols=["x"], outputCols=["b"], duplicates="drop").fit(df)
    assert {r.b for r in model.transform(df).collect()} == {0}
    with pytest.raises(ValueError, match="labels"):
        binner(["x"], duplicates="drop").fit(df)


def test_frozen_edges_cover_new_rows_and_survive_saving(spark, sample):
    _, df = sample
    model = binner(["credit"]).fit(df)
    path = scratch_path(spark, "binner")
    PipelineModel([model]).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert isinstance(loaded.stages[0], QuantileBinnerModel)
    first = int(model.getOrDefault("edges")[0][1])  # an edge belongs to the bin below it
    new = spark.createDataFrame([(1, -5), (2, 10**9), (3, None), (4, first)], "id int, credit long")
    got = {r.id: r.credit_bin for r in loaded.transform(new).collect()}
    assert got == {1: "low", 2: "high", 3: None, 4: "low"}


def test_intervals_match_pandas(sample):
    frame, df = sample
    want = sorted(pd.qcut(frame["credit"], 4).unique())
    rows = bin_intervals(df, "credit", LABELS).orderBy("lo").collect()
    assert [(r.lo, r.hi) for r in rows] == [(i.left, i.right) for i in want]
    assert [r.label for r in rows] == LABELS and rows[0].lo == frame["credit"].min() - 0.001


def test_intervals_of_tiny_values_get_more_digits_and_repeated_edges_raise(spark):
    values = pd.Series([x * 1.013e-5 for x in range(1, 41)])
    rows = bin_intervals(spark.createDataFrame(pd.DataFrame({"x": values})), "x", LABELS).orderBy("ordinal").collect()
    want = sorted(pd.qcut(values, 4).unique())
    assert [r.hi for r in rows] == [i.right for i in want] and [r.lo for r in rows[1:]] == [i.left for i in want[1:]]
    with pytest.raises(ValueError, match="unique"):
        bin_intervals(spark.createDataFrame([(1,)] * 10 + [(2,)], "x int"), "x", LABELS)
    with pytest.raises(ValueError, match="no values"):
        bin_intervals(spark.createDataFrame([(None,)], "x int"), "x", LABELS)


@pytest.mark.parametrize("local_rows", [3, 1_000_000])
def test_a_null_group_is_a_group(spark, local_rows):
    rows = [(g, float(x)) for g in (None, 1) for x in range(8)] + [(2, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = bin_by_group(df, ["g"], {"x": "b"}, {"x": LABELS}, local_rows=local_rows).collect()
    want = {float(x): LABELS[x // 2] for x in range(8)}
    assert {(r.g, r.x): r.b for r in got} == {(g, x): b for g in (None, 1) for x, b in want.items()} | {(2, None): None}
    with pytest.raises(ValueError, match="keep"):
        bin_by_group(df, ["g"], {"x": "b"}, {"x": LABELS}, duplicates="drop")


@pytest.mark.parametrize("local_rows", [50, 1_000_000])
def test_bins_per_group(spark, local_rows):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"id": range(900), "g": np.where(rng.random(900) < 0.6, 0, rng.integers(1, 6, 900))})
    frame["x"] = np.round(rng.normal(100, 30, 900), 3)
    df = bin_by_group(spark.createDataFrame(frame), ["g"], {"x": "b"}, {"x": LABELS}, local_rows=local_rows)
    got = df.toPandas().sort_values("id").reset_index(drop=True)
    want = frame.groupby("g")["x"].transform(lambda s: pd.qcut(s, 4, labels=LABELS).astype(str))
    assert (got["b"] == want).all() and len(got) == 900


def test_one_row_group_has_no_edges(spark):
    df = spark.createDataFrame([(1, 5.0)], "g int, x double")
    with pytest.raises(ValueError, match="unique"):
        bin_by_group(df, ["g"], {"x": "b"}, {"x": LABELS})
