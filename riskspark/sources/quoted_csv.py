"""CSV with line breaks inside quoted fields, read from many splits of a file at once.

Where a split of a file begins, nobody can tell whether the place is inside a quoted field. But each split can count its
quotes, and whether it begins inside a field follows from the parity of all quotes before it. So one pass counts quotes, with
one row per split as its outcome; a running sum over a file's splits gives each split its state; a second pass puts the lines
of a split together. A record that begins in one split and ends in a later one comes out in fragments, two per split at most,
which are joined by file and place.

Only counts and fragments are shuffled, never the texts. Records are written once, and columns are taken from them by the
header of their own file.

The rule holds for files in which quotes stand around fields and a quote inside is doubled; a lone quote in a field without
quotes would turn the rest of its file inside out, and the number of quotes of such a file is odd: it is refused by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..schema import APPLICANT_COLUMNS, LABELLED
from ..session import materialize
from .files import settings, typed
from .payload import csv_fields

#: What a piece of text is: a whole record, one that goes on in the next split, the end of one, or a part without either end.
WHOLE, OPEN, END, MIDDLE = range(4)
_PIECE = pa.schema([("split", pa.int64()), ("nth", pa.int64()), ("part", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])
_PIECES = "split bigint, nth bigint, part int, first boolean, text string"
#: Splits are read by so many tasks, or by one for so many bytes, where there are more splits.
TASKS, TASK_BYTES = 64, 32 << 20
#: Pieces that leave a task together.
BATCH_BYTES, BATCHES = 4 << 20, 1000


def _split_bytes(spark: SparkSession) -> int:
    """The most bytes of a split, from the session's setting, which may have a unit."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, start, split, nth, odd, text): the lines of each split in their order; ``odd`` numbers of quotes turn the state.

    A task reads several small splits one after the other, so that neither tasks nor written files are as many as splits.
    """
    raw = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = raw.select(file.alias("file"), start.alias("start"), F.xxhash64(file, start).alias("split"),
                       F.monotonically_increasing_id().alias("nth"), (quotes % 2 == 1).alias("odd"), F.col("value").alias("text"))
    splits = raw.rdd.getNumPartitions()
    tasks = max(TASKS, -(-splits * _split_bytes(spark) // TASK_BYTES))
    return lines.coalesce(tasks) if tasks < splits else lines


def split_states(lines: DataFrame) -> DataFrame:
    """(split, file, start, inside): whether a split begins inside a quoted field."""
    parity = lines.groupBy("split", "file", "start").agg((F.sum(F.col("odd").cast("int")) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return parity.select("split", "file", "start", "odd", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Split:
    """The records of one split, from its lines in order."""

    def __init__(self, split: int, inside: bool, begins_file: bool, nth: int) -> None:
        self.split, self.inside, self.first, self.start_nth = split, inside, begins_file, nth
        self.held: list[str] = []
        self.held_at, self.own = 0, not inside

    def add(self, nth: np.ndarray, odd: np.ndarray, text: pa.Array) -> Iterator[pa.RecordBatch]:
        inside = (np.cumsum(odd) - odd + self.inside) % 2 == 1  # before each line
        odd = odd.astype(bool)
        plain = ~inside & ~odd
        if plain.any():
            yield self._batch(nth[plain], np.full(int(plain.sum()), WHOLE, np.int32), text.filter(pa.array(plain)))
        others = np.flatnonzero(~plain)
        done = []
        for i, line in zip(others.tolist(), text.take(pa.array(others)).to_pylist()):
            if not inside[i]:
                self.held, self.held_at, self.own = [line], int(nth[i]), True
                continue
            if not self.held:
                self.held_at = int(nth[i])
            self.held.append(line)
            if odd[i]:
                done.append(self._taken(WHOLE if self.own else END))
                self.own = True
        if done:
            at, part, texts = zip(*done)
            yield self._batch(np.array(at), np.array(part, np.int32), pa.array(texts, pa.string()))
        self.inside = bool((odd.sum() + self.inside) % 2)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            at, part, text = self._taken(OPEN if self.own else MIDDLE)
            yield self._batch(np.array([at]), np.array([part], np.int32), pa.array([text], pa.string()))

    def _taken(self, part: int) -> tuple[int, int, str]:
        text, self.held = "\n".join(self.held), []
        return self.held_at, part, text

    def _batch(self, nth: np.ndarray, part: np.ndarray, text: pa.Array) -> pa.RecordBatch:
        # A file's header is the record that begins with its first line.
        first = (nth == self.start_nth) & self.first
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(nth), self.split)), pa.array(nth), pa.array(part), pa.array(first), text.cast(pa.string())], schema=_PIECE)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``BATCH_BYTES`` or ``BATCHES`` small ones: a split of a few records is not sent on its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BATCH_BYTES or len(held) == BATCHES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Split | None = None
    last = -1
    for batch in batches:
        if not batch.num_rows:
            continue
        split, nth, odd = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("split", "nth", "odd"))
        same = np.r_[now is not None and split[0] == now.split, split[1:] == split[:-1]]
        if (np.diff(nth, prepend=last)[same] <= 0).any():
            raise RuntimeError("lines came out of their order")
        last = int(nth[-1])
        cuts = [0, *(np.flatnonzero(split[1:] != split[:-1]) + 1).tolist(), len(split)]
        for lo, hi in zip(cuts, cuts[1:]):
            if now is None or split[lo] != now.split:
                if now is not None:
                    yield from now.rest()
                inside = batch.column("inside")[lo].as_py()
                if inside is None:
                    raise RuntimeError("a file has changed, or was split anew, between two passes")
                now = _Split(int(split[lo]), inside, batch.column("begins")[lo].as_py(), int(nth[lo]))
            yield from now.add(nth[lo:hi], odd[lo:hi].astype(np.int64), batch.column("text").slice(lo, hi - lo))
    if now is not None:
        yield from now.rest()


def _joined(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """(file, first, text) of the records that lie in several splits."""
    parts = pieces.where(F.col("part") != WHOLE).join(states.select("split", "file", "start"), "split")
    # In a split the end of an earlier record comes before the start of another.
    opens = (F.col("part") == OPEN).cast("int")
    upto = Window.partitionBy("file").orderBy("start", opens).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("record", F.sum(opens).over(upto))
    ordered = F.array_sort(F.collect_list(F.struct("start", opens.alias("opens"), "text")))
    return numbered.groupBy("file", "record").agg(F.max("first").alias("first"), F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text")).select(
        "file", "first", "text")


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, first, text): the records of CSV files, written once; ``first`` marks headers."""
    # Splits depend on the files alone: the number of cores, which may change between two passes, has no part in them.
    with settings(spark, spark_sql_files_minPartitionNum=1):
        lines = _lines(spark, path)
        states = materialize(split_states(lines), "split-states")
        odd = states.groupBy("file").agg(F.sum("odd").alias("n")).where("n % 2 = 1").select("file").take(1)
        if odd:
            raise ValueError(f"{odd[0].file}: a quote is not closed")
        begins = (F.col("start") == 0).alias("begins")
        # Two numbers for each split; a shuffle would take the lines out of their order.
        told = lines.join(F.broadcast(states.select("split", "inside")), "split", "left").select("split", "nth", "odd", "text", "inside", begins)
        pieces = materialize(told.mapInArrow(lambda b: _together(_pieces(b)), _PIECES), "csv-pieces")
    whole = pieces.where(F.col("part") == WHOLE).join(states.select("split", "file"), "split").select("file", "first", "text")
    ended = F.regexp_replace("text", "\r$", "")
    every = whole.unionByName(_joined(pieces, states)).select("file", "first", ended.alias("text"))
    return every.withColumn("text", F.when(F.col("first"), F.regexp_replace("text", "^﻿", "")).otherwise(F.col("text")))


def read_quoted_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = LABELLED,
    names: Mapping[str, str] = APPLICANT_COLUMNS,
) -> DataFrame:
    """CSV with a header whose quoted fields may hold line breaks; columns are taken by name, as far as any file has them.

    Files may have different headers. Empty lines are no records. A record of too few fields has nulls at its end.
    """
    records = read_records(spark, path)
    titles = F.transform(csv_fields(F.col("text")), lambda t: F.trim(t))
    # The size of splits is meant for the files, not for the written pieces.
    with settings(spark, spark_sql_files_maxPartitionBytes=max(_split_bytes(spark), TASK_BYTES)):
        headers = materialize(records.where("first").select("file", titles.alias("titles")), "csv-headers")
    # One row per set of columns, not per file.
    known = {t for r in headers.select("titles").distinct().collect() for t in r.titles}
    outer = {v: k for k, v in names.items()}
    present = [f for f in schema if outer.get(f.name, f.name) in known]

    def place(name: str) -> Column:
        return F.array_position("titles", outer.get(name, name)).cast("int")

    places = headers.select("file", F.struct(F.lit(0).alias("__none"), *[place(f.name).alias(f.name) for f in present]).alias("places"))
    cells = records.where("not first and text <> ''").select("file", csv_fields(F.col("text")).alias("cells")).join(places, "file")
    texts = cells.select(*[F.get("cells", F.when(F.col(f"places.`{f.name}`") > 0, F.col(f"places.`{f.name}`") - 1)).alias(f.name) for f in present])
    return typed(texts, T.StructType(present))
