"""Near-duplicate groups by SimHash fingerprints and BK-trees.

A fingerprint is 64 bits of majority votes over the hashes of a text's word shingles. Two fingerprints link when they
differ in at most ``radius`` bits; components are the transitive closure of the links.

Cutting the 64 bits into ``blocks`` fields, two linked fingerprints agree on at least ``blocks - radius`` of them, so they
meet in a shard named by some choice of that many fields and their values. Each shard's distinct fingerprints form a BK-tree
(children keyed by their integer Hamming distance to the parent), which is searched along the edges within the radius only.
The shards hold all fingerprints and so grow with the data; they reach their searches by a shuffle, as a broadcast of them
would have no size bound. A shard over ``SHARD_ROWS`` is cut into parts that meet in pairs, one task per pair. A shard gives
one edge per fingerprint to the smallest it is connected with, never its pairs.

Defined cases: null and empty texts, and texts without words, have fingerprint zero and link as any other. A null id never
names a component unless all ids of it are null. Equal texts and repeated rows share a fingerprint; each row is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import small_batches, text_or_empty

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Fingerprints of a shard that one tree holds; more are cut into parts.
SHARD_ROWS = 4096
#: Fingerprints wanted in a shard on average; the number of fields follows from it and from the number of fingerprints.
SHARD_MEAN = 32
_VOTE_ROWS = 65536


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text as an unsigned number."""
    return int(_fingerprints([text], shingle)[0])


def _fingerprints(texts: list[str], shingle: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    votes = np.zeros((len(texts), 64), np.int64)
    counts = np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    owners: list[tuple[int, int]] = []

    def count() -> None:
        if not hashes:
            return
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = 0
        for row, n in owners:
            votes[row] += bits[at:at + n].sum(axis=0, dtype=np.int64)
            at += n
        hashes.clear()
        owners.clear()

    for row, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        span = min(shingle, len(words)) - 1
        first, last = starts[: len(words) - span].tolist(), ends[span:].tolist()
        counts[row] = len(first)
        for at in range(0, len(first), _VOTE_ROWS):
            piece = [digest(joined[a:b], SEED) for a, b in zip(first[at:at + _VOTE_ROWS], last[at:at + _VOTE_ROWS])]
            hashes += piece
            owners.append((row, len(piece)))
            if len(hashes) >= _VOTE_ROWS:
                count()
    count()
    packed = np.packbits(votes * 2 > counts[:, None], axis=1, bitorder="little")
    return packed.view(np.uint64).reshape(-1)


def fingerprint(text: str | Column, shingle: int = SHINGLE) -> Column:
    """Column of fingerprints as signed 64-bit numbers."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(_fingerprints(texts.tolist(), shingle).view(np.int64))

    return of.asNondeterministic()(text_or_empty(text))  # so that it is not evaluated twice


class BkTree:
    """Tree of distinct numbers; a child hangs on its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        at = 0
        while at != new:
            at = self.children[at].setdefault((self.values[at] ^ value).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the numbers at most ``radius`` bits away."""
        found, open_ = [], [0] if self.values else []
        while open_:
            at = open_.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            for edge, child in self.children[at].items():
                if distance - radius <= edge <= distance + radius:
                    open_.append(child)
        return found


def _stars(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """(number, smallest number it is connected with) for the numbers of one shard that have links."""
    tree, parent = BkTree(), list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, value in enumerate(values):
        for j in tree.within(value, radius):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
        tree.add(value)
    for i, value in enumerate(values):
        if (top := root(i)) != i:
            yield value, values[top]


def _links(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Edges of the shards of one partition, whose rows come sorted by shard."""
    rest = None
    for frame in frames:
        shards, values = frame["shard"].to_numpy(), frame["fp"].to_numpy()
        if rest is not None:
            shards, values = np.concatenate((rest[0], shards)), np.concatenate((rest[1], values))
        if not len(shards):
            continue
        cut = int(np.searchsorted(shards, shards[-1]))
        rest = shards[cut:], values[cut:]
        yield _edges(shards[:cut], values[:cut], radius)
    if rest is not None:
        yield _edges(*rest, radius)


def _edges(shards: np.ndarray, values: np.ndarray, radius: int) -> pd.DataFrame:
    starts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(shards) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(shards)] if len(shards) else starts
    out: list[tuple[int, int]] = []
    for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        found = np.unique(values[a:b].view(np.uint64))  # the parts of a pair may repeat a number
        out += _stars(found.tolist(), radius)
    pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})


def _fields(blocks: int) -> list[tuple[int, int]]:
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def field_count(n: int, radius: int = RADIUS, mean: int = SHARD_MEAN) -> int:
    """Fields to cut 64 bits into, so that shards of ``n`` fingerprints hold about ``mean`` of them."""
    for blocks in range(radius + 2, radius + 7):
        if n <= mean << (64 * (blocks - radius) // blocks):
            return blocks
    return radius + 6


def linked(fingerprints: DataFrame, radius: int = RADIUS, blocks: int | None = None,
           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (u, v) that connect just the numbers of column ``fp`` (distinct) which links connect; v < u unsigned."""
    spark = fingerprints.sparkSession
    if blocks is None:
        blocks = field_count(fingerprints.count(), radius)
    keys = []
    for nth, chosen in enumerate(combinations(_fields(blocks), blocks - radius)):
        parts = [F.shiftrightunsigned(F.col("fp"), at).bitwiseAND((1 << width) - 1) for at, width in chosen]
        keys.append(F.xxhash64(F.lit(nth), *parts))  # a clash of two shards costs a larger tree, no row
    spread = fingerprints.select("fp", F.explode(F.array(*keys)).alias("shard"))
    sizes = spread.groupBy("shard").count().where(F.col("count") > shard_rows)
    large = materialize(sizes.select("shard", F.ceil(F.col("count") / shard_rows).alias("parts")), "large-shards")
    cells = spread
    if not large.isEmpty():
        part = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts"))
        pairs = F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda other: F.xxhash64("shard", F.least(part, other), F.greatest(part, other)))
        cut = spread.join(large, "shard").select("fp", F.explode(pairs).alias("shard"))
        cells = spread.join(large, "shard", "left_anti").select("fp", "shard").unionByName(cut)
    small_batches(spark)
    return (
        cells.repartition("shard").sortWithinPartitions("shard")
        .mapInPandas(lambda frames: _links(frames, radius), "u bigint, v bigint")
        .distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node that has links, but for the smallest of its component, with that smallest one.

    Large-star and small-star steps in turn, each written to the shared folder, until the edges no longer change.
    """
    edges = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        )
        edges = materialize(small, "edges")
        after = _signature(edges)
        if after == before:
            return edges
        before = after


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, blocks: int | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    small_batches(docs.sparkSession)
    prints = materialize(docs.select(F.col(key).cast("bigint").alias("id"), fingerprint(text, shingle).alias("fp")), "prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = components(linked(nodes.select("fp"), radius, blocks, shard_rows))
    member = nodes.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = member.join(named, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows whose id names their component, with the columns they came with; rows that share an id stay together."""
    found = near_duplicates(docs, key, text, **options)
    names = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__name")).distinct()
    return docs.join(names, docs[key].cast("bigint").eqNullSafe(names["__name"]), "left_semi")
