"""Exact deduplication by skew-safe combining: local winners, salted digest groups, then one winner per content.

Texts are equal when they are identical after every character of ``[\\x20\\x09-\\x0D]`` is deleted. Each of the three
combining steps groups by digest *and* whole content, so a digest shared by different contents never merges them.

Defined cases: a null text counts as empty, and all empty texts are one group. A null id ranks behind every other id and
is the ``keep_id`` only of a group in which all ids are null. Rows that repeat id, content and length are marked alike;
``first_rows`` keeps one of them. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import text_or_empty

BLANKS = r"[\x20\x09-\x0D]+"
#: Pieces into which a group is cut before its winners meet; a group's rows in the last step are at most this many.
SALTS = 16
#: Width of the id part of a rank: ids are moved to 0 .. 2**64 - 1, and 2**64 stands for null.
_ID = 2**65
_NULL_ID = 2**64
_LENGTHS = 2**31


def content(text: str | Column) -> Column:
    return F.regexp_replace(text_or_empty(text), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _whole(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def _rank(points: Column, key: Column) -> Column:
    """Longest text first, then smallest id, as one number: a fixed-width aggregate needs no sort of the texts."""
    moved = F.coalesce(key.cast("decimal(20,0)") + _whole(2**63), _whole(_NULL_ID))
    return ((_whole(_LENGTHS) - points.cast("decimal(20,0)")) * _whole(_ID) + moved).cast("decimal(38,0)")


def _ranked_id(rank: Column) -> Column:
    moved = rank % _whole(_ID)
    return F.when(moved < _whole(_NULL_ID), (moved - _whole(2**63)).cast("bigint"))


def _keyed(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    body = docs.select(F.col(key).cast("bigint").alias("id"), F.char_length(text_or_empty(text)).alias("points"),
                       content(text).alias("content"))
    return body.withColumn("digest", digest(F.col("content")))


def content_groups(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per content: digest, content, keep_id, points of the winner and number of rows."""
    salted = (
        keyed.withColumn("rank", _rank(F.col("points"), F.col("id")))
        .withColumn("salt", F.pmod(F.xxhash64("id", "points"), F.lit(salts)))
        .groupBy("digest", "content", "salt")
        .agg(F.min("rank").alias("rank"), F.max("points").alias("points"), F.count("*").alias("size"))
    )
    return (
        salted.repartition("digest").groupBy("digest", "content")
        .agg(F.min("rank").alias("rank"), F.max("points").alias("points"), F.sum("size").alias("size"))
        .select("digest", "content", _ranked_id(F.col("rank")).alias("keep_id"), "points", "size")
    )


def winners(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS,
            digest: Callable[[Column], Column] = sha256) -> tuple[DataFrame, DataFrame | None]:
    """Winners of the digests with one content, and, if any digest has several, the winners of those with content."""
    groups = content_groups(_keyed(docs, key, text, digest), salts)
    by_digest = materialize(
        groups.groupBy("digest").agg(
            F.count("*").alias("contents"), F.first("keep_id").alias("keep_id"), F.first("points").alias("best"),
            F.first("size").alias("size")),
        "digest-winners")
    several = by_digest.where("contents > 1").select("digest")
    if several.isEmpty():
        return by_digest, None
    shared = groups.join(several, "digest", "left_semi").withColumnRenamed("points", "best")
    return by_digest.where("contents = 1"), shared


def mark(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS,
         digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the content)."""
    alone, shared = winners(docs, key, text, salts, digest)
    rows = _keyed(docs, key, text, digest)
    slim = rows.select("id", "points", "digest", sha256(F.col("content")).alias("text_sha256"))
    found = slim.join(alone.select("digest", "keep_id", "best", "size"), "digest")
    if shared is not None:
        rest = rows.join(shared.select("digest", "content", "keep_id", "best", "size"), ["digest", "content"])
        found = found.unionByName(rest.select("digest", "id", "points", sha256(F.col("content")).alias("text_sha256"),
                                              "keep_id", "best", "size"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("best"))).alias("kept"), "text_sha256")


def first_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS,
               digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows that stay, one per content, with the columns they came with."""
    alone, shared = winners(docs, key, text, salts, digest)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).cast("bigint").alias("id"),
        F.char_length(text_or_empty(text)).alias("points"), content(text).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))

    def staying(side: DataFrame, *on: str) -> DataFrame:
        # The winner's own id is in the join key, so a large group is no hot key here.
        mine = rows if "content" in on else rows.drop("content")
        keys = side.select(*on, F.col("keep_id").alias("w_id"), F.col("best").alias("w_best"))
        match = [mine[c] == keys[c] for c in on]
        kept = mine.join(keys, [*match, mine["id"].eqNullSafe(keys["w_id"]), mine["points"] == keys["w_best"]])
        part = [mine[c] for c in on]
        again = F.row_number().over(Window.partitionBy(*part, mine["id"], mine["points"]).orderBy(mine["points"]))
        return kept.select("row", again.alias("nth")).where("nth = 1").select("row.*")

    kept = staying(alone, "digest")
    return kept if shared is None else kept.unionByName(staying(shared, "digest", "content"))


SQL = r"""WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents),
  r AS (SELECT doc_id, content, first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size FROM n)
  SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM r"""
