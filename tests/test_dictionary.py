import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskspark.operators import dictionary, encode
from riskspark.session import materialize


@pytest.fixture(scope="module")
def few(spark):
    rows = [(1, "b", 10, True, 2.5), (2, "a", 2, False, 10.0), (3, None, None, None, None), (4, "b", 2, True, -1.0), (5, "é", 10, None, 2.5)]
    return materialize(spark.createDataFrame(rows, "id int, c string, j int, f boolean, x double"), "few")


COLUMNS = ["c", "j", "x"]


def vectors(df, column="features"):
    return {r.id: list(r.v) for r in df.select("id", vector_to_array(column).alias("v")).collect()}


@pytest.mark.parametrize("hot_share", [0.0, 0.3, 1.0])
@pytest.mark.parametrize("local_rows", [2, 1000])
def test_positions_are_those_of_the_fitted_encoder(few, hot_share, local_rows):
    names = dictionary.build_dictionary(few, COLUMNS, local_rows)
    want = encode.fit_encoder(few, COLUMNS)
    got = [(r.feature, r.category) for r in names.orderBy("position").collect()]
    assert got == encode.feature_names(want)
    assert got[:3] == [("c", "a"), ("c", "b"), ("c", "é")] and got[3:5] == [("j", "2"), ("j", "10")] and got[5] == ("x", "-1.0")
    coded = dictionary.encode(few, "id", names, COLUMNS, hot_share)
    mine = dictionary.sparse_vectors(coded, dictionary.width(names))
    texts = few.select("id", *[F.col(c).cast("string").alias(c) for c in COLUMNS])
    assert vectors(mine) == vectors(want.transform(texts)) and vectors(mine)[3] == [0.0] * len(got)
    assert mine.schema["features"].dataType == want.transform(texts).schema["features"].dataType


def test_unknown_and_empty(spark, few):
    names = dictionary.build_dictionary(few, ["c"])
    new = spark.createDataFrame([(1, "z"), (2, "a"), (3, None)], "id int, c string")
    got = {r.id: r.indices for r in dictionary.encode(new, "id", names, ["c"]).collect()}
    assert got == {1: [], 2: [0], 3: []}
    flags = dictionary.build_dictionary(few, ["f"])
    assert [(r.category, r.n) for r in flags.orderBy("position").collect()] == [("false", 1), ("true", 2)]
    none = dictionary.build_dictionary(few.where("id < 0"), ["c", "j"])
    assert dictionary.width(none) == 0
    assert {r.id: r.indices for r in dictionary.encode(new, "id", none, ["c"]).collect()} == {1: [], 2: [], 3: []}
    assert dictionary.encode(new.where("id < 0"), "id", names, ["c"]).count() == 0


def test_many_categories_never_reach_the_driver(spark, monkeypatch):
    """A column of 10^5 categories beside one category that holds a third of all rows."""
    rows = materialize(spark.range(300_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(
        (F.col("id") * 7919) % 100_000).alias("v"), (F.col("id") % 5).cast("string").alias("w")), "wide")
    taken = []
    for name in ("collect", "toPandas", "toLocalIterator"):
        original = getattr(DataFrame, name)
        monkeypatch.setattr(type(rows), name, lambda df, *a, _f=original, _n=name, **k: taken.append(_n) or _f(df, *a, **k))
    names = dictionary.build_dictionary(rows, ["v", "w"], local_rows=20_000)
    coded = materialize(dictionary.sparse_vectors(dictionary.encode(rows, "id", names, ["v", "w"]), dictionary.width(names)), "coded")
    assert taken == []
    monkeypatch.undo()
    distinct = rows.select("v").distinct().count()
    assert distinct > 60_000 and dictionary.width(names) == distinct + 5
    # The place of a number is the count of smaller ones.
    order = {r.category: r.position for r in names.where("feature = 'v'").collect()}
    assert [int(c) for c, _ in sorted(order.items(), key=lambda e: e[1])] == sorted(int(c) for c in order)
    assert sorted(order.values()) == list(range(distinct))
    for r in coded.join(rows, "id").where("id % 9973 = 0").collect():
        assert r.features.indices.tolist() == [order[str(r.v)], distinct + int(r.w)] and r.features.size == distinct + 5
    assert coded.count() == 300_000


def test_only_hot_entries_are_broadcast_by_hint(spark):
    rows = materialize(spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v")), "hot")
    names = dictionary.build_dictionary(rows, ["v"])
    hot, rest = dictionary._split(names, 0.002)
    assert [r.category for r in hot.collect()] == ["-1"] and rest.count() == 2000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a dictionary beyond the limit
        found = dictionary.encoded_cells(rows, "id", names, ["v"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "Python" not in plan
        assert found.select("id").distinct().count() == found.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
