"""The consistent-hash ring with bounded loads against a plain version that moves one row after another."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from riskspark.llm import shard_ring as op


def signed(n):
    return n - 2**64 if n >= 2**63 else n


def plain_shards(keys, shards, virtual, most):
    """(home, shard) counts by arcs, moving single rows clockwise in rounds."""
    places, owners = op.ring(shards, virtual)
    standing = []
    for k in keys:
        position = signed(xxhash.xxh64_intdigest(b"" if k is None else f"k{k}".encode(), 42))
        standing.append(int(np.searchsorted(places, position)) % len(places))
    home = [int(owners[a]) for a in standing]
    load, result, arcs = [0] * shards, Counter(), list(standing)
    waiting = list(range(len(keys)))
    while waiting:
        rest = []
        for i in sorted(waiting, key=lambda i: arcs[i]):
            shard = int(owners[standing[i]])
            if load[shard] < most[shard]:
                load[shard] += 1
                result[arcs[i], shard] += 1
            else:
                rest.append(i)
        for i in rest:
            while load[owners[standing[i]]] >= most[owners[standing[i]]]:
                standing[i] = (standing[i] + 1) % len(places)
        waiting = rest
    return home, arcs, result


def check(got, texts, shards, apart=1):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in texts)
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(shards)}
    assert all(x == list(range(len(x))) for x in slots.values())
    sizes = [len(x) for x in slots.values()]
    assert max(sizes) - min(sizes) <= apart
    assert {(r.law, r.grown_shard) for r in got} <= {("rows", None)}


@pytest.mark.parametrize("virtual,bucket_rows", [(1, 1), (16, 3), (128, 4096)])
def test_against_plain(spark, docs_of, virtual, bucket_rows):
    texts = [(i * 7919, f"text {i}") for i in range(300)] + [(5, "same key")] * 140 + [(None, None)] * 21 + [(6, "é")]
    got = op.assign(docs_of(texts).repartition(5), virtual=virtual, bucket_rows=bucket_rows).collect()
    check(got, texts, 8)
    keys = [k for k, _ in texts]
    places, owners = op.ring(8, virtual)
    home, arcs, want = plain_shards(keys, 8, virtual, op.bounds(len(keys), [sum(owners[a] == s for a in plain_arcs(keys, virtual)) for s in range(8)], 0))
    arc_of = dict(zip(keys, arcs))
    assert Counter((arc_of[r.doc_id], r.shard) for r in got) == want
    assert Counter(home) == Counter(r.home_shard for r in got)


def plain_arcs(keys, virtual):
    places, _ = op.ring(8, virtual)
    return [int(np.searchsorted(places, signed(xxhash.xxh64_intdigest(b"" if k is None else f"k{k}".encode(), 42)))) % len(places) for k in keys]


def test_partitions_change_nothing(spark, docs_of):
    texts = [(i % 90, f"t{i % 45}") for i in range(400)]
    one = sorted(tuple(r) for r in op.assign(docs_of(texts).coalesce(1), bucket_rows=10).collect())
    assert one == sorted(tuple(r) for r in op.assign(docs_of(texts[::-1]).repartition(7), bucket_rows=10).collect())


def test_fewer_rows_than_shards_and_no_rows(spark, docs_of):
    check(op.assign(docs_of(["a", "b", None])).collect(), [(1, "a"), (2, "b"), (3, None)], 8)
    assert op.assign(docs_of([]).where("false")).count() == 0


def test_one_more_shard_moves_few_rows(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    eight, nine = (op.assign(docs, shards=n, slack=0.1).select("doc_id", "shard") for n in (8, 9))
    both = eight.join(nine.withColumnRenamed("shard", "then"), "doc_id").where("shard <> then")
    assert both.count() < 0.3 * 20_000  # a hash modulo the shards would move 8 of 9
    loads = [r["count"] for r in eight.groupBy("shard").count().collect()]
    assert max(loads) <= np.ceil(20_000 * 1.1 / 8)


def test_fill_moves_clockwise():
    # Arc 1 overflows shard 1 and goes on to shard 2, then round to shard 0.
    assert op.fill([0, 1, 2], [1, 7, 1], [3, 3, 3]) == [(0, 0, 1, 0, 0), (1, 0, 3, 1, 0), (2, 0, 1, 2, 0), (1, 3, 5, 2, 1), (1, 5, 7, 0, 1)]


def test_whole_rows_with_clashing_columns_and_written_shards(spark, tmp_path):
    rows = [(i, f"t{i}", i % 3, "x") for i in range(50)] + [(None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid int, slot string")
    got = op.place(docs).collect()
    assert sorted((tuple(r.row) for r in got), key=repr) == sorted(rows, key=repr)
    with pytest.raises(ValueError, match="slot"):
        op.write_shards(docs, str(tmp_path / "a"))
    op.write_shards(docs.drop("slot"), str(tmp_path / "b"), files=2)
    back = spark.read.parquet(str(tmp_path / "b"))
    assert sorted((tuple(r) for r in back.select("doc_id", "text", "uid").collect()), key=repr) == sorted((r[:3] for r in rows), key=repr)
    assert back.groupBy("shard").agg({"slot": "max"}).count() == 8
