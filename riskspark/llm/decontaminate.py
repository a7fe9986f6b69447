"""Benchmark decontamination by Wu-Manber search over words.

Both sides are lower-cased in A-Z and cut into words of digits, letters and characters beyond ASCII. The search strings are
the runs of ten words of the benchmark items, or a whole item of fewer words. They are grouped by length; for each length a
shift table over blocks of two words says how far the search may jump, blocks with shift zero select the strings that end
there, and their words are compared directly.

The search strings are collected in blocks of at most ``STRINGS`` and each block is broadcast alone. With several blocks
the documents are written with a row number, and the findings of the blocks are merged by it, whatever the ids.

Defined cases: null and empty texts have no words, so no hits; an item without words is never found. Items may repeat; an
item with a null id marks words as hit but is not counted or listed. Repeated documents each get their row.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import kept_rows, small_batches, text_or_empty, with_answer

WINDOW = 10
#: Search strings in one broadcast block.
STRINGS = 200_000
_KEEP = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz")
#: Bytes of a word stay, A-Z are lowered, all other ASCII becomes a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEEP or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Search:
    """Wu-Manber tables for word strings, each with the numbers of the items it stands for."""

    def __init__(self, strings: dict[tuple[bytes, ...], list[str]]):
        self.ids: dict[bytes, int] = {}
        self.one: dict[int, list[str]] = {}
        self.tables: list[tuple[int, dict, dict]] = []
        by_length: dict[int, list] = defaultdict(list)
        for words, items in strings.items():
            number = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in words)
            by_length[len(words)].append((number, items))
        for length, found in sorted(by_length.items()):
            if length == 1:
                self.one = {number[0]: items for number, items in found}
                continue
            shift: dict[tuple[int, int], int] = {}
            bucket: dict[tuple[int, int], list] = defaultdict(list)
            for number, items in found:
                for end in range(1, length):
                    block = number[end - 1], number[end]
                    shift[block] = min(shift.get(block, length), length - 1 - end)
                bucket[number[-2], number[-1]].append((list(number), items))
            self.tables.append((length, shift, dict(bucket)))

    def find(self, words: list[bytes]) -> tuple[set[int], set[str]]:
        """Places of hit words, and the items found."""
        get = self.ids.get
        text = [get(w, 0) for w in words]
        hit: set[int] = set()
        items: set[str] = set()
        if not any(text):
            return hit, items
        if self.one:
            for at, number in enumerate(text):
                if number in self.one:
                    hit.add(at)
                    items.update(self.one[number])
        size = len(text)
        for length, shift, bucket in self.tables:
            at, far, step = length - 1, length - 1, shift.get
            while at < size:
                block = text[at - 1], text[at]
                jump = step(block, far)
                if jump:
                    at += jump
                    continue
                start = at - length + 1
                piece = text[start:at + 1]
                for number, of in bucket[block]:
                    if number == piece:
                        hit.update(range(start, at + 1))
                        items.update(of)
                at += 1
        return hit, items


def search_strings(benchmark: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows (string, item): the word strings of the items, words joined by a blank; item is null for a null id."""
    lowered = F.translate(text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    strings = F.transform(starts, lambda i: F.array_join(F.slice("words", i, window), " "))
    return (
        benchmark.select(F.col(key).cast("string").alias("item"), words.alias("words")).where(F.size("words") > 0)
        .select("item", F.explode(strings).alias("string")).distinct()
    )


def _block(rows: list) -> dict:
    """A block's strings as plain data, as executors need not have the class of the tables."""
    strings: dict[tuple[bytes, ...], list[str]] = defaultdict(list)
    for row in rows:
        items = strings[tuple(row["string"].encode("utf-8", "surrogatepass").split(b" "))]
        if row["item"] is not None:
            items.append(row["item"])
    return {"strings": dict(strings)}


def _tables(search: Broadcast) -> Search:
    held = search.value  # one dict per worker process, so the tables are built once in it
    if "search" not in held:
        held["search"] = Search(held["strings"])
    return held["search"]


def _finding(search: Broadcast, text: str | Column) -> Column:
    """Struct (n_words, hit, items) of a text for one broadcast block."""

    @F.pandas_udf("n_words bigint, hit array<int>, items array<string>")
    def of(texts: pd.Series) -> pd.DataFrame:
        table, out = _tables(search), []
        for words in map(words_of, texts):
            hit, items = table.find(words)
            out.append((len(words), sorted(hit), sorted(items)))
        return pd.DataFrame(out, columns=["n_words", "hit", "items"])

    return of.asNondeterministic()(text_or_empty(text))


def _report(n_words: Column, hit: Column, items: Column) -> list[Column]:
    return [
        n_words.alias("n_words"), F.size(hit).cast("bigint").alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.size(hit) > 0).alias("contaminated")]


def _findings(docs: DataFrame, benchmark: DataFrame, text: str, window: int, strings: int):
    """The broadcast blocks of search strings, one after the other."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = materialize(search_strings(benchmark, window=window), "search-strings")
    blocks = max(1, -(-rows.count() // strings))
    if blocks == 1:
        yield 1, spark.sparkContext.broadcast(_block(rows.collect()))
        return
    for nth in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("string"), F.lit(blocks)) == nth)
        yield blocks, spark.sparkContext.broadcast(_block(part.collect()))


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         strings: int = STRINGS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, parts = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text")), []
    for blocks, search in _findings(docs, benchmark, text, window, strings):
        if blocks == 1:
            found = rows.select("doc_id", _finding(search, "text").alias("f")).select("doc_id", "f.*")
            return found.select("doc_id", *_report(F.col("n_words"), F.col("hit"), F.col("items")))
        if not parts:  # written, so that the row numbers are the same for all blocks
            rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "documents")
        found = rows.select("row", "doc_id", _finding(search, "text").alias("f")).select("row", "doc_id", "f.*")
        parts.append(materialize(found, "findings"))
        search.unpersist()
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    merged = merged.groupBy("row", "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.select("doc_id", *_report(F.col("n_words"), F.col("hit"), F.col("items")))


def clean_rows(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
               strings: int = STRINGS) -> DataFrame:
    """The rows without any hit, with the columns they came with."""
    for blocks, search in _findings(docs, benchmark, text, window, strings):
        docs = kept_rows(with_answer(docs, F.size(_finding(search, text)["hit"])), F.col("__answer") == 0)
        if blocks > 1:
            docs = materialize(docs, "clean-rows")
            search.unpersist()
    return docs


SQL = r"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
  b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
  w AS (SELECT DISTINCT item, least(10, len(words)) AS n,
          array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS string
        FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
  p AS (SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS string
        FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM w)
              WHERE len(words) >= n)),
  m AS (SELECT doc_id, item, p.i, p.n FROM p JOIN w ON p.string = w.string AND p.n = w.n),
  h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM m) GROUP BY 1),
  t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY 1)
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id"""
