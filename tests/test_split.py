import pytest
from pyspark.sql import functions as F

from riskspark.operators import split
from riskspark.operators.split import class_quotas, stratified_split


def assign(df, **options):
    return {r.id: r.is_test for r in stratified_split(df, "id", "y", **options).collect()}


@pytest.fixture(scope="module")
def rows(spark):
    # One class holds two thirds of the rows.
    return spark.range(1003).select("id", F.when(F.col("id") % 3 < 2, "a").when(F.col("id") % 7 == 0, "b").otherwise("c").alias("y"))


def test_counts_are_exact(spark, rows):
    split_rows = stratified_split(rows, "id", "y")
    assert split_rows.count() == 1003
    n = {r.y: (r.n, r.t) for r in split_rows.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert sum(t for _, t in n.values()) == 201
    quotas = {r.y: (r.n, r.n_test) for r in class_quotas(rows.groupBy("y").agg(F.count("*").alias("n")), "y", 0.2).collect()}
    assert n == quotas
    assert all(abs(t - m * 0.2) < 1 for m, t in n.values())


def test_independent_of_partitioning_and_of_the_prefix(rows, monkeypatch):
    base = assign(rows)
    assert assign(rows.repartition(13)) == base
    monkeypatch.setattr(split, "_prefix_digits", lambda rows: 1)
    assert assign(rows) == base
    assert assign(rows, seed=7) != base


def test_matches_a_plain_ranking(rows):
    import hashlib

    by_class = {}
    for r in rows.collect():
        by_class.setdefault(r.y, []).append((hashlib.md5(f"42:{r.id}".encode()).hexdigest(), r.id))
    quotas = {r.y: r.n_test for r in class_quotas(rows.groupBy("y").agg(F.count("*").alias("n")), "y", 0.2).collect()}
    test = {i for y, keys in by_class.items() for _, i in sorted(keys)[: quotas[y]]}
    assert {i for i, t in assign(rows).items() if t} == test


def test_largest_remainder_ties_go_by_label(spark):
    counts = spark.createDataFrame([("F", 4933), ("O", 4979), ("P", 5088)], "y string, n long")
    got = {r.y: (r.n_train, r.n_test) for r in class_quotas(counts, "y", 0.2).collect()}
    assert got == {"F": (3947, 986), "O": (3983, 996), "P": (4070, 1018)}


def test_repeated_keys_at_the_cut_are_refused(spark):
    rows = spark.createDataFrame([(1, "a")] * 10, "id int, y string")
    with pytest.raises(Exception, match="not unique"):
        stratified_split(rows, "id", "y").collect()


def test_prefixes_get_longer_with_the_rows():
    assert [split._prefix_digits(n) for n in (10, 10**8, 10**12)] == [2, 3, 6]


def test_bad_labels(spark):
    with pytest.raises(ValueError, match="nulls"):
        stratified_split(spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, y string"), "id", "y")
    with pytest.raises(ValueError, match="two rows"):
        stratified_split(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, y string"), "id", "y")


def test_the_table_is_not_shuffled(rows):
    plan = stratified_split(rows, "id", "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and "Join LeftOuter" in plan
