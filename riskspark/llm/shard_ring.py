"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard stands at ``VIRTUAL`` places of a ring of 64-bit hashes. A row's key falls into an arc of the ring and belongs to
the shard at the arc's clockwise end. A shard takes no more rows than its bound; the rest of an arc continues clockwise to the
next virtual node whose shard has room. All arcs move in rounds: rows close to their home come before rows from further off.

With ``slack`` 0 the bounds add up to the number of rows and differ by one at most, so the law is ``rows``: counts at most one
apart. With a slack of, say, 0.25 a shard takes up to 1.25 times its share, and fewer rows leave their home.

At scale: only counts per arc go to the driver, ``shards * virtual`` numbers whatever the rows. There the rounds turn into
intervals: ranks ``lo`` to ``hi`` of an arc go to a shard and its slots from ``base`` on. A row's rank in its arc is a prefix
sum over hash buckets of the arc plus its place in its bucket. A bucket has a bounded number of rows, also in an arc that holds
a third of the table: buckets are cut by a hash of key, text and copy number, and the number of buckets follows the arc's rows.

Rows are put in order by a hash of (key, size, text's crc32, copy), so the assignment does not depend on how the table is
split into files; copies of one row are alike and share their places in any order.

Defined cases: a null text has no bytes, and a null key is a key of its own. Repeated keys share an arc and overflow like any
other rows. With fewer rows than shards some shards stay empty. An empty table gives no rows. Other columns are not read by
``assign`` and are kept, whatever they are called, by ``place``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize
from .common import text_or_empty

SHARDS, VIRTUAL = 8, 128
#: Rows wanted in a bucket of an arc, and buckets of all arcs at most (beyond that, buckets grow).
BUCKET_ROWS, BUCKETS = 4096, 1 << 20
#: Rows of one partition are numbered below this by ``monotonically_increasing_id``.
_PART = 33


def ring(shards: int, virtual: int = VIRTUAL) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the virtual nodes in ring order, and their shards. A shard's places do not depend on the others."""
    import xxhash

    at = {}
    for shard in range(shards):
        for node in range(virtual):
            at.setdefault(xxhash.xxh64_intdigest(f"shard {shard} node {node}".encode(), 42) - 2**63, shard)
    places = sorted(at)
    return np.array(places, np.int64), np.array([at[p] for p in places], np.int64)


def bounds(rows: int, demand: Sequence[int], slack: float) -> list[int]:
    """Most rows of each shard. Without slack the rows that do not divide go where most are wanted."""
    shards = len(demand)
    if slack > 0:
        return [int(np.ceil(rows * (1 + slack) / shards))] * shards
    first = sorted(range(shards), key=lambda s: (-demand[s], s))[:rows % shards]
    return [rows // shards + (s in first) for s in range(shards)]


def fill(owners: Sequence[int], counts: Sequence[int], most: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """Intervals (arc, lo, hi, shard, base): the rows of each arc go clockwise until a shard has room for them."""
    arcs, free, used = len(owners), list(most), [0] * len(most)
    at, lo, out = list(range(arcs)), [0] * arcs, []
    while any(lo[a] < counts[a] for a in range(arcs)):
        for a in range(arcs):
            shard = owners[at[a]]
            n = min(counts[a] - lo[a], free[shard])
            if n > 0:
                out.append((a, lo[a], lo[a] + n, shard, used[shard]))
                lo[a], free[shard], used[shard] = lo[a] + n, free[shard] - n, used[shard] + n
        for a in range(arcs):
            while lo[a] < counts[a] and not free[owners[at[a]]]:
                at[a] = (at[a] + 1) % arcs
    return out


def _key_text(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit(""))


def _arc(places: np.ndarray):
    @F.pandas_udf("int")
    def arc(position: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(places, position.to_numpy(np.int64)) % len(places)).astype(np.int32))

    return arc


def _slim(numbered: DataFrame, key: Column, text: Column, places: np.ndarray) -> DataFrame:
    """(uid, doc_id, size, text_crc32, same, arc) of every row; ``same`` is equal for copies."""
    body = text_or_empty(text)
    size, crc = F.octet_length(body).cast("bigint") + 1, F.crc32(body.cast("binary"))
    found = numbered.select("uid", key.alias("doc_id"), size.alias("size"), crc.alias("text_crc32"), F.xxhash64(_key_text(key)).alias("position"))
    same = F.xxhash64("position", "size", "text_crc32")
    return found.select("uid", "doc_id", "size", "text_crc32", same.alias("same"), _arc(places)("position").alias("arc"))


def _with_copies(slim: DataFrame) -> DataFrame:
    """``copy`` numbers equal rows from 0: within the partition that wrote them, then over partitions."""
    part = F.shiftright("uid", _PART)
    several = materialize(slim.groupBy("same").count().where("count > 1").select("same"), "repeated")
    repeated = slim.join(several, "same").withColumn("part", part)
    before = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = repeated.groupBy("same", "part").count().select(
        "same", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("same", "part").orderBy("uid")) - 1
    numbered = repeated.withColumn("own", own).join(parts, ["same", "part"])
    alone = slim.join(several, "same", "left_anti").withColumn("copy", F.lit(0).cast("bigint"))
    return alone.unionByName(numbered.withColumn("copy", F.col("own") + F.col("first")).select(alone.columns))


def _assigned(numbered: DataFrame, key: Column, text: Column, shards: int, virtual: int, slack: float,
              bucket_rows: int) -> DataFrame:
    """(uid, doc_id, size, text_crc32, shard, slot, home_shard) of the numbered rows."""
    spark: SparkSession = numbered.sparkSession
    places, owners = ring(shards, virtual)
    rows = _with_copies(materialize(_slim(numbered, key, text, places), "ring-rows"))
    counts = np.zeros(len(places), np.int64)
    for r in rows.groupBy("arc").count().collect():  # one number per arc
        counts[r["arc"]] = r["count"]
    total = int(counts.sum())
    demand = np.bincount(owners, counts, shards).astype(np.int64).tolist()
    intervals = fill(owners.tolist(), counts.tolist(), bounds(total, demand, slack))
    wanted = max(bucket_rows, total // BUCKETS)
    bits = [int(-(-int(n) // wanted)).bit_length() for n in counts]
    spread = F.xxhash64("same", "copy")
    # No shift by 64: an arc has one bit at least.
    bucket = F.shiftrightunsigned(spread, 1)
    width = F.get(F.lit([max(1, b) for b in bits]), F.col("arc"))
    bucket = F.floor(bucket / F.pow(F.lit(2.0), 63 - width)).cast("bigint")
    keyed = materialize(rows.withColumns({"spread": spread, "bucket": bucket}), "ring-buckets")
    upto = Window.partitionBy("arc").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("arc", "bucket").count().select(
        "arc", "bucket", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("arc", "bucket").orderBy("spread", "same", "copy")) - 1
    ranked = keyed.withColumn("place", place).join(starts, ["arc", "bucket"]).withColumn("rank", F.col("first") + F.col("place"))
    # At most a few rows per arc, whatever the table.
    to = F.broadcast(spark.createDataFrame(intervals, "to_arc int, lo long, hi long, shard int, base long"))
    home = F.get(F.lit(owners.tolist()), F.col("arc")).cast("int")
    return ranked.join(to, (F.col("arc") == F.col("to_arc")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).select(
        "uid", "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"),
        home.alias("home_shard"))


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, virtual: int = VIRTUAL,
           slack: float = 0.0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard.

    ``law`` is ``rows`` without slack and ``bounded`` with it; ``grown_shard`` belongs to another law and is null.
    """
    numbered = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("uid"))
    found = _assigned(numbered, F.col("key"), F.col("text"), shards, virtual, slack, bucket_rows)
    return found.select("doc_id", "size", "text_crc32", F.lit("bounded" if slack > 0 else "rows").alias("law"), "shard",
                        "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard")


def place(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, virtual: int = VIRTUAL,
          slack: float = 0.0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Whole rows with their place, as (shard, slot, row): ``row`` is a struct of the columns of ``docs``.

    The rows are written once, so that the number each gets stays with it.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = materialize(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("uid")), "ring-texts")
    found = _assigned(numbered, F.col(f"row.`{key}`"), F.col(f"row.`{text}`"), shards, virtual, slack, bucket_rows)
    return numbered.join(found.select("uid", "shard", "slot"), "uid").select("shard", "slot", "row")


def write_shards(docs: DataFrame, path: str, files: int = 8, mode: str = "error", **options: object) -> None:
    """One folder per shard, ``files`` files in each, a file holding a range of slots in their order."""
    placed = place(docs, **options)
    names = docs.columns
    if {"shard", "slot"} & set(names):
        raise ValueError("columns shard and slot are written by this operator; rename those of the table")
    ends = placed.groupBy("shard").agg((F.max("slot") + 1).alias("n"))
    cut = placed.join(F.broadcast(ends), "shard").withColumn("file", F.floor(F.col("slot") * files / F.col("n")))
    by = cut.repartition(max(1, files * int(options.get("shards", SHARDS))), "shard", "file").sortWithinPartitions("shard", "file", "slot")
    by.select("shard", "slot", "row.*").write.mode(mode).partitionBy("shard").parquet(path)
