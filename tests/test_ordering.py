import numpy as np
import pandas as pd
import pytest

from riskspark.operators.ordering import ordered


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("local_rows", [37, 10_000])
def test_running_sums_and_neighbours(spark, descending, local_rows):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"k": rng.permutation(500) * 1.5, "v": rng.integers(0, 9, 500)})
    table = ordered(spark.createDataFrame(frame), ["k"], descending, local_rows)
    assert (table.parts > 1) == (local_rows < 500)
    got = table.scan(sums={"run": "v"}, before={"prev": "v", "prev_k": "k"}, after={"next": "v"}).toPandas()
    assert set(got.columns) == {"k", "v", "run", "prev", "prev_k", "next"}
    want = frame.sort_values("k", ascending=not descending).reset_index(drop=True)
    got = got.sort_values("k", ascending=not descending).reset_index(drop=True)
    assert (got["run"] == want["v"].cumsum()).all()
    pd.testing.assert_series_equal(got["prev"], want["v"].shift(), check_names=False, check_dtype=False)
    pd.testing.assert_series_equal(got["prev_k"], want["k"].shift(), check_names=False, check_dtype=False)
    pd.testing.assert_series_equal(got["next"], want["v"].shift(-1), check_names=False, check_dtype=False)


def test_small_ranges_share_tasks(spark):
    """Ranges far more than tasks: a file for each of them would grow with the table."""
    table = ordered(spark.range(4_000).selectExpr("(id * 7919) % 4001 AS k"), ["k"], local_rows=10)
    assert table.parts == 400 and len(table.df.inputFiles()) <= 32
    sizes = [r["count"] for r in table.df.groupBy("_part").count().collect()]
    assert sum(sizes) == 4_000 and max(sizes) <= 10
    got = table.scan(before={"prev": "k"}).orderBy("k").collect()
    assert [r.prev for r in got] == [None, *[r.k for r in got[:-1]]]
