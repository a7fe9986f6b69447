import threading

import pytest
from pyspark.sql import functions as F

from riskspark.session import scratch_path
from riskspark.sources import versions


def numbers(df):
    return sorted(r[0] for r in df.collect())


def test_the_last_version_counts_and_earlier_ones_stay(spark):
    root = scratch_path(spark, "root")
    assert versions.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError, match="nothing"):
        versions.read_version(spark, root)
    for n in (3, 5):
        versions.publish_version(spark.range(n), root)
    assert [v.number for v in versions.versions(spark, root)] == [1, 2]
    assert numbers(versions.read_version(spark, root)) == list(range(5))
    assert numbers(versions.read_version(spark, root, 1)) == list(range(3))
    with pytest.raises(FileNotFoundError, match="no version 7"):
        versions.read_version(spark, root, 7)
    schema = versions.read_version(spark, root).schema
    versions.publish_version(spark.range(0), root)
    assert numbers(versions.read_version(spark, root, schema=schema)) == []


def test_a_failed_publication_leaves_the_old_rows(spark):
    root = scratch_path(spark, "root")
    versions.publish_version(spark.range(4), root)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        versions.publish_version(bad, root)
    assert numbers(versions.read_version(spark, root)) == [0, 1, 2, 3]
    assert versions.drop_versions(spark, root, keep=1, lost_after_hours=-1) == []  # the lost folder alone
    assert [v.folder for v in versions.versions(spark, root)] == versions._names(spark, f"{root}/data")
    assert numbers(versions.read_version(spark, root)) == [0, 1, 2, 3]


def test_readers_see_whole_versions_while_others_are_published(spark):
    """Version k holds k rows of the value k; a reader must see k of one k."""
    root, seen, faults = scratch_path(spark, "root"), [], []
    rows = lambda k: spark.range(0, 40 * k, 1, 4).select(F.lit(k).alias("k"))
    versions.publish_version(rows(1), root)
    ended = threading.Event()

    def read():
        try:
            while not ended.is_set():
                seen.append([(r.k, r.n) for r in versions.read_version(spark, root).groupBy("k").agg(F.count("*").alias("n")).collect()])
        except Exception as failure:  # noqa: BLE001 - shown by the assertion
            faults.append(failure)

    reader = threading.Thread(target=read)
    reader.start()
    held = versions.read_version(spark, root)
    for k in range(2, 7):
        versions.publish_version(rows(k), root)
    ended.set()
    reader.join()
    assert not faults and seen
    assert all(len(found) == 1 and found[0][1] == 40 * found[0][0] for found in seen)
    assert held.count() == 40  # a reader keeps its version


def test_publications_at_the_same_time_are_both_whole(spark):
    root = scratch_path(spark, "root")
    publish = lambda k: versions.publish_version(spark.range(10 * k), root)
    both = [threading.Thread(target=publish, args=(k,)) for k in (1, 2)]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert len(versions.versions(spark, root)) == 2
    assert versions.read_version(spark, root).count() in (10, 20)


def test_old_versions_are_dropped_and_the_current_one_stays(spark):
    root = scratch_path(spark, "root")
    for n in range(1, 5):
        versions.publish_version(spark.range(n), root)
    assert [v.number for v in versions.drop_versions(spark, root, keep=2)] == [1, 2]
    assert [v.number for v in versions.versions(spark, root)] == [3, 4]
    assert len(versions._names(spark, f"{root}/data")) == 2
    assert versions.read_version(spark, root).count() == 4
    assert versions.publish_version(spark.range(9), root).number == 5
    with pytest.raises(ValueError, match="stay"):
        versions.drop_versions(spark, root, keep=0)
