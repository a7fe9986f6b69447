"""Side-by-side check of a registered query and its SQL: ``python tests/compare.py [folder] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if value is None:
        return ("", "null")
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, float) and math.isnan(value):
        return ("n", "nan")
    if hasattr(value, "as_tuple"):
        value = float(value)
    if isinstance(value, (int, float)):
        return ("n", repr(float(value)))
    return ("s", str(value))


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, fn, sql):
    """(problem or None, rows, seconds)."""
    start = time.time()
    df = fn(spark, folder)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if not sql:
        return (None if got[1] else "no rows"), len(got[1]), took
    cur = con.execute(sql)
    want = normal([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}", len(got[1]), took
    if got[1] != want[1]:
        left, right = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
        return (
            f"rows {len(got[1])} / {len(want[1])}; only ours {sorted(left)[:2]}; only SQL {sorted(right)[:2]}",
            len(got[1]), took,
        )
    return None, len(got[1]), took


if __name__ == "__main__":
    import __spark_entry__ as e
    from riskspark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "compare", "local[8]", spark_sql_shuffle_partitions=8, spark_ui_enabled="false", spark_driver_memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    connection, sqls = duck(folder), e.oracle_sql()
    failed = 0
    for name, fn in e.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        try:
            problem, n, took = compare(session, connection, folder, fn, sqls.get(name))
        except Exception as failure:  # noqa: BLE001
            problem, n, took = f"{type(failure).__name__}: {str(failure)[:600]}", 0, 0.0
        failed += problem is not None
        print(f"{name:28s} {n:8d} {took:7.2f}s {'ok' if problem is None else 'FAIL ' + problem}", flush=True)
    print("failed:", failed)
