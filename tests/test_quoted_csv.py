"""Quoted CSV from several splits against Python's own csv module."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from riskspark.sources import quoted_csv

SCHEMA = T.StructType([T.StructField("key", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def made_up(seed, rows, end="\n"):
    rng = random.Random(seed)
    bits = ["x", "é", " ", ",", '"', "\n", "word", "\n\n", '",\n"', "\t", "7,8\n9,", ""]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["key", "b", "a"])
    want = []
    for i in range(rows):
        a, b = ("".join(rng.choice(bits) for _ in range(rng.randrange(12))) + "." for _ in range(2))
        writer.writerow([i, b, a])
        want.append((i, a, b))
    return out.getvalue(), want


@pytest.fixture
def split_bytes(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]

    def to(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")

    yield to
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


@pytest.mark.parametrize("size,end", [(150, "\n"), (400, "\r\n"), (10**8, "\n")])
def test_records_across_splits(spark, tmp_path, split_bytes, size, end):
    split_bytes(size)
    want = []
    for i in range(2):
        text, rows = made_up(size + i, 40, end)
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
        want += rows
    assert list(csv.reader(io.StringIO(text)))[1:][3] == [str(rows[3][0]), rows[3][2], rows[3][1]]
    got = quoted_csv.read_quoted_csv(spark, str(tmp_path), SCHEMA, {})
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_one_record_longer_than_many_splits(spark, tmp_path, split_bytes):
    split_bytes(16)
    long = "\n".join(f"line {i}, with a comma" for i in range(12))
    (tmp_path / "a.csv").write_text(f'key,a\n1,"{long}"\n2,short\n\n3,"{long}"', encoding="utf-8")
    got = quoted_csv.read_quoted_csv(spark, str(tmp_path), SCHEMA, {})
    assert got.columns == ["key", "a"]
    assert sorted(map(tuple, got.collect())) == [(1, long), (2, "short"), (3, long)]


def test_headers_differ_and_may_have_line_breaks_and_marks(spark, tmp_path, split_bytes):
    split_bytes(5)
    (tmp_path / "a.csv").write_text('﻿key,"my\nb"\n1,x\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('spare,a,key\n"s\ns","t\nt",2\n,,3\n4\n', encoding="utf-8")
    got = quoted_csv.read_quoted_csv(spark, str(tmp_path), SCHEMA, {"my\nb": "b"})
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, None, "x"), (2, "t\nt", None), (3, None, None), (None, None, None)], key=repr)


def test_an_open_quote_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('key,a\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="a.csv: a quote is not closed"):
        quoted_csv.read_quoted_csv(spark, str(tmp_path), SCHEMA, {})


def test_texts_are_not_shuffled_and_settings_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text("key,a\n1,x\n")
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    got = quoted_csv.read_quoted_csv(spark, str(tmp_path), SCHEMA, {})
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before
    assert [tuple(r) for r in got.collect()] == [(1, "x")]
    (tmp_path / "b.csv").write_text("")
    assert got.sparkSession.read.text(str(tmp_path)).count() == 2


def test_small_splits_share_tasks(spark, tmp_path, split_bytes):
    """Neither tasks nor files of pieces may be as many as splits."""
    split_bytes(8)
    text, want = made_up(3, 90)
    (tmp_path / "a.csv").write_bytes(text.encode())
    lines = quoted_csv._lines(spark, str(tmp_path))
    assert lines.select("split").distinct().count() > 2 * quoted_csv.TASKS
    assert lines.rdd.getNumPartitions() == quoted_csv.TASKS
    assert sorted(map(tuple, quoted_csv.read_quoted_csv(spark, str(tmp_path), SCHEMA, {}).collect())) == sorted(want)
