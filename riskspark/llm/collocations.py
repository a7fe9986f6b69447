"""Phrase collocations by SON partitioning, per language.

A text is lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words ``[^\\x20\\x09]+``. Phrases are
contiguous words of a piece. The corpus is dealt into ``SHARDS`` shards. A phrase with ``support`` occurrences in a language
has, in at least one shard, its share of them: ``ceil(support * words of the shard / all words)``. So each shard is mined
completely at that lower support, the phrases frequent in any shard are united, and then all of these, and nothing else, are
counted over the whole corpus.

A shard has no size limit, as it is mined by many tasks. Its texts lie in chunks of about ``CHUNK_BYTES``, written once. A
chunk sends the distinct words and two-word phrases to buckets by their hash, 32 bits and a count each; a bucket adds up the
counts of each shard and sends back one bit for each that it was sent: frequent in some shard or not. Three-word phrases are
sent in a second step, only where both their two-word parts came back frequent. Hashes choose candidates only: two phrases
with one hash can make a rare one a candidate, never lose one. Candidates are counted exactly, by their words.

A phrase, however frequent, has one entry per chunk. Nothing is broadcast or gathered but sums per shard and language.

Defined cases: a null text is empty, a null language is ``und`` (with the texts whose language is that word). Repeated rows
count each. Ties in score and count are ordered by the phrase's UTF-8 bytes. An empty table, or one without a phrase of
enough support, gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import small_batches, text_or_empty

SUPPORT, LONGEST, COVERED, TOP = 10, 3, 50, 2000
SHARDS = 4
#: Text bytes of a chunk, and words of the corpus for each bucket.
CHUNK_BYTES, BUCKET_WORDS = 8 << 20, 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Ends a piece; no byte of any UTF-8 text.
_END = b"\xff"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b" " + _END * 10)


class Words:
    """The words of a chunk: ``ids`` in order of the texts, 0 between pieces, else numbers of a (language, word)."""

    def __init__(self, texts: list[bytes], langs: list[str]) -> None:
        """``texts`` holds the joined texts of each language."""
        self.langs = langs
        flat, owner = [], []
        for i, text in enumerate(texts):
            data = np.frombuffer(text.translate(_TABLE).replace(_END, b" " + _END + b" ") + b" " + _END + b" ", np.uint8)
            letter = data != 32
            starts = np.flatnonzero(letter & ~np.r_[False, letter[:-1]])
            packed = np.cumsum(letter)  # bytes of words up to here
            at = np.r_[packed[starts] - 1, packed[-1]]
            tokens = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[letter].tobytes())])
            flat.append(tokens)
            owner.append(np.full(len(starts), i, np.int64))
        coded = pa.concat_arrays(flat).dictionary_encode() if flat else pa.array([], pa.large_binary()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        code, owner = coded.indices.to_numpy().astype(np.int64), np.concatenate(owner) if owner else np.zeros(0, np.int64)
        end = words.index(_END) if _END in words else -1
        real = code != end
        key, at = np.unique(owner[real] * len(words) + code[real], return_inverse=True)
        self.ids = np.zeros(len(code), np.int64)
        self.ids[real] = at + 1
        self.lang = np.r_[-1, key // max(1, len(words))]
        self.word = [b"", *(words[c] for c in (key % max(1, len(words))).tolist())]

    def count(self) -> np.ndarray:
        """Words of each language."""
        return np.bincount(self.lang[self.ids[self.ids > 0]], minlength=len(self.langs))

    def hashes(self) -> np.ndarray:
        import xxhash

        return np.array([xxhash.xxh64_intdigest(w, 42) for w in self.word], np.uint64)


class Phrases:
    """The distinct phrases of one length in a chunk: their words, counts and languages; ``at`` has the phrase that starts at
    each place of the chunk, or -1."""

    def __init__(self, cols: list[np.ndarray], n: np.ndarray, at: np.ndarray) -> None:
        self.cols, self.n, self.at = cols, n, at

    @staticmethod
    def single(words: Words) -> Phrases:
        n = np.bincount(words.ids, minlength=len(words.word))[1:]
        return Phrases([np.arange(1, len(words.word))], n, words.ids - 1)

    def longer(self, words: Words, frequent: np.ndarray | None) -> Phrases:
        """One word more; with ``frequent``, only phrases of which both the first and the last part are."""
        wide, at = len(words.word), np.full(len(self.at), -1, np.int64)
        step = len(self.cols)
        if len(at) <= step:
            return Phrases([np.zeros(0, np.int64)] * (step + 1), np.zeros(0, np.int64), at)
        ok = self.at >= 0 if frequent is None else np.r_[frequent, False][self.at]
        head, tail = ok[:-1], ok[1:] if step > 1 else self.at[1:] >= 0
        starts = np.flatnonzero(head & tail & (words.ids[step:] > 0)[:len(head)] if step == 1 else head & tail)
        key = self.at[starts] * wide + words.ids[starts + step]
        distinct, place, n = np.unique(key, return_inverse=True, return_counts=True)
        at[starts] = place
        return Phrases([*(c[distinct // wide] for c in self.cols), distinct % wide], n, at)

    def mixed(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(self.n), len(self.cols), np.uint64)
        for c in self.cols:
            out = (out ^ hashes[c]) * _MIX
            out ^= out >> np.uint64(29)
        return out


def _dealt(words: Words, phrases: Phrases, hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(language, bucket, places, 32-bit hashes) of the phrases by language and bucket, in a fixed order."""
    mixed = phrases.mixed(hashes)
    bucket, low = (mixed >> np.uint64(32)) % np.uint64(buckets), (mixed & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    group = words.lang[phrases.cols[0]] * buckets + bucket.astype(np.int64)
    by = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.r_[True, group[by][1:] != group[by][:-1]]) if len(by) else np.zeros(0, np.int64)
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(by)]):
        places = by[lo:hi]
        yield int(group[places[0]] // buckets), int(group[places[0]] % buckets), places, low[places]


_CHUNK = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64()))])
_CHUNKS = "chunk bigint, shard int, langs array<string>, words array<bigint>, texts array<binary>, sizes array<bigint>"
_SENT = pa.schema([("size", pa.int32()), ("lang", pa.string()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("shard", pa.int32()), ("hashes", pa.binary()), ("n", pa.binary())])
_SENDS = "size int, lang string, bucket int, chunk bigint, shard int, hashes binary, n binary"
_BACK = pa.schema([("to_chunk", pa.int64()), ("size", pa.int32()), ("lang", pa.string()), ("bucket", pa.int32()), ("frequent", pa.binary())])
_BACKS = "to_chunk bigint, size int, lang string, bucket int, frequent binary"


def _chunks(batches: Iterator[pa.RecordBatch], size: int, shards: int) -> Iterator[pa.RecordBatch]:
    """One row per chunk: compressed texts by language. Chunks go round the shards."""
    from pyspark import TaskContext

    task, nth = TaskContext.get().partitionId(), 0
    texts: dict[str, list[bytes]] = {}
    held = 0

    def row() -> pa.RecordBatch:
        langs = sorted(texts)
        joined = [_END.join(texts[x]) for x in langs]
        words = Words(joined, langs).count().tolist()
        packed = [pa.compress(x, "zstd", asbytes=True) for x in joined]
        values = [(task << 32) + nth, (task + nth) % shards, langs, words, packed, [len(x) for x in joined]]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _CHUNK)], schema=_CHUNK)

    for batch in batches:
        for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
            texts.setdefault(lang, []).append(text)
            held += len(text) + 1
            if held >= size:
                yield row()
                nth, texts, held = nth + 1, {}, 0
    if held:
        yield row()


def _read(chunks: pa.Table | pa.RecordBatch, row: int) -> tuple[int, int, Words]:
    chunk, shard, langs, texts, sizes = (chunks.column(c)[row].as_py() for c in ("chunk", "shard", "langs", "texts", "sizes"))
    joined = [pa.decompress(t, n, "zstd", asbytes=True) if n else b"" for t, n in zip(texts, sizes)]
    return chunk, shard, Words(joined, langs)


def _blobs(chunk: int, shard: int, size: int, words: Words, phrases: Phrases, hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    rows = [(size, words.langs[lang], bucket, chunk, shard, low.tobytes(), phrases.n[places].astype(np.uint32).tobytes())
            for lang, bucket, places, low in _dealt(words, phrases, hashes, buckets)]
    cols = zip(*rows) if rows else [[]] * len(_SENT)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _SENT)], schema=_SENT)


def _sent(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct words and two-word phrases of chunks, by bucket."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk, shard, words = _read(batch, row)
            hashes, one = words.hashes(), Phrases.single(words)
            yield _blobs(chunk, shard, 1, words, one, hashes, buckets)
            yield _blobs(chunk, shard, 2, words, one.longer(words, None), hashes, buckets)


def _mined(sent: pa.Table) -> pa.Table:
    """One bucket: what is frequent in some shard, told to every chunk that sent it."""
    parts = [np.frombuffer(x, np.uint32) for x in sent.column("hashes").to_pylist()]
    n = np.concatenate([np.frombuffer(x, np.uint32) for x in sent.column("n").to_pylist()]).astype(np.int64)
    distinct, at = np.unique(np.concatenate(parts), return_inverse=True)
    shard, least = sent.column("shard").to_numpy(), sent.column("least").to_numpy()
    shards = np.repeat(shard, [len(p) for p in parts])
    frequent = np.zeros(len(distinct), bool)
    for s in np.unique(shard):
        mine = shards == s
        frequent |= np.bincount(at[mine], n[mine], len(distinct)) >= least[shard == s][0]
    found = np.split(frequent[at], np.cumsum([len(p) for p in parts])[:-1])
    bits = pa.array([np.packbits(f).tobytes() for f in found], pa.binary())
    return pa.table([sent.column("chunk"), sent.column("size"), sent.column("lang"), sent.column("bucket"), bits], schema=_BACK)


def _frequent(words: Words, phrases: Phrases, hashes: np.ndarray, buckets: int, size: int, back: dict) -> np.ndarray:
    out = np.zeros(len(phrases.n), bool)
    for lang, bucket, places, _ in _dealt(words, phrases, hashes, buckets):
        bits = back.get((size, words.langs[lang], bucket))
        if bits is not None:
            out[places] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(places)).astype(bool)
    return out


def _told(back: pa.Table) -> dict:
    return {(s, x, b): f for s, x, b, f in zip(*(back.column(c).to_pylist() for c in ("size", "lang", "bucket", "frequent")))}


def _sent_longer(chunks: pa.Table, back: pa.Table, buckets: int) -> pa.Table:
    """The three-word phrases of one chunk whose parts are frequent somewhere, by bucket."""
    if not len(chunks):
        return _SENT.empty_table()
    chunk, shard, words = _read(chunks, 0)
    hashes, told = words.hashes(), _told(back)
    two = Phrases.single(words).longer(words, None)
    three = two.longer(words, _frequent(words, two, hashes, buckets, 2, told))
    return pa.Table.from_batches([_blobs(chunk, shard, 3, words, three, hashes, buckets)])


_COUNTS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.binary()), ("f", pa.int64())])


def _counted(chunks: pa.Table, back: pa.Table, buckets: int) -> pa.Table:
    """The candidates in one chunk, by their words, with their counts."""
    if not len(chunks):
        return _COUNTS.empty_table()
    _, _, words = _read(chunks, 0)
    hashes, told = words.hashes(), _told(back)
    one = Phrases.single(words)
    two = one.longer(words, None)
    frequent = _frequent(words, two, hashes, buckets, 2, told)
    three = two.longer(words, frequent)
    out = []
    letters = pa.array(words.word, pa.binary())
    langs = pa.array([None, *words.langs], pa.string())
    for size, phrases, kept in ((1, one, _frequent(words, one, hashes, buckets, 1, told)), (2, two, frequent),
                                (3, three, _frequent(words, three, hashes, buckets, 3, told))):
        import pyarrow.compute as pc

        cols = [c[kept] for c in phrases.cols]
        text = pc.binary_join_element_wise(*[letters.take(pa.array(c)) for c in cols], pa.scalar(b" ", pa.binary())) if size > 1 else letters.take(pa.array(cols[0]))
        lang = langs.take(pa.array(words.lang[cols[0]] + 1))
        out.append(pa.table([lang, pa.array([size] * len(text), pa.int32()), text, pa.array(phrases.n[kept].astype(np.int64))], schema=_COUNTS))
    return pa.concat_tables(out)


def _decimal(c: Column) -> Column:
    return c.cast("decimal(15,0)")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact: the products have up to 36 digits."""
    top = F.lit(1_000_000).cast("decimal(7,0)") * _decimal(a) * _decimal(a)
    return F.call_function("floor", F.call_function("div", top, _decimal(left) * _decimal(right))).cast("bigint")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, shards: int = SHARDS,
                     chunk_bytes: int = CHUNK_BYTES, bucket_words: int = BUCKET_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all words and phrases of up to three words with ``support``, and (lang, n) of all words."""
    small_batches(docs.sparkSession)
    rows = docs.select(text_or_empty(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    chunks = materialize(rows.mapInArrow(lambda b: _chunks(b, chunk_bytes, shards), _CHUNKS), "chunks")
    shares = materialize(
        chunks.select("shard", F.inline(F.arrays_zip(F.col("langs").alias("lang"), F.col("words").alias("n"))))
        .groupBy("shard", "lang").agg(F.sum("n").alias("n")), "shares")
    sizes = materialize(shares.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    # ceil(support * share), in whole numbers; a shard without words has nothing to send.
    least = shares.join(sizes.withColumnRenamed("n", "total"), "lang").where("n > 0").select(
        "shard", "lang", F.expr(f"({support} * n + total - 1) div total").alias("least"))
    least = materialize(least, "local-supports")
    buckets = max(1, -(-int(sizes.agg(F.sum("n")).first()[0] or 0) // bucket_words))

    def mined(sent: DataFrame) -> DataFrame:
        return materialize(sent.join(least, ["shard", "lang"]).groupBy("size", "lang", "bucket").applyInArrow(_mined, _BACKS), "frequent")

    short = mined(chunks.mapInArrow(lambda b: _sent(b, buckets), _SENDS))
    long = mined(chunks.groupBy("chunk").cogroup(short.groupBy("to_chunk")).applyInArrow(lambda c, b: _sent_longer(c, b, buckets), _SENDS))
    both = short.unionByName(long)
    found = chunks.groupBy("chunk").cogroup(both.groupBy("to_chunk")).applyInArrow(
        lambda c, b: _counted(c, b, buckets), "lang string, size int, phrase binary, f bigint")
    total = found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= support)
    return materialize(total, "frequent-phrases"), sizes


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, covered: int = COVERED, top: int = TOP,
         shards: int = SHARDS, chunk_bytes: int = CHUNK_BYTES, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase counts by its weakest cut. It goes if a longer phrase with ``covered`` per cent of its occurrences holds it.
    """
    counts, sizes = frequent_phrases(docs, text, lang, support, shards, chunk_bytes, bucket_words)
    counts = counts.withColumn("phrase", F.col("phrase").cast("string"))
    words = F.split("phrase", " ")
    part = lambda c, lo, n: F.array_join(F.slice(c, lo, n), " ")
    phrases = counts.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), words.alias("words"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", part(F.col("words"), 1, F.col("k")).alias("head"),
                       part(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    of = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    cuts = cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(weakest).select(
        "lang", "phrase", "size", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    held = phrases.where("size > 2").select("lang", "a", F.explode(F.array_distinct(F.array(
        part(F.col("words"), 1, 2), part(F.col("words"), 2, 2)))).alias("phrase"))
    held = held.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = scored.join(held, ["lang", "phrase"], "left").where(
        (F.col("size") > 2) | F.col("within").isNull() | (100 * F.col("within") < covered * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
      unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
  words AS (SELECT lang, len(p) AS size, array_to_string(p, ' ') AS phrase FROM (
    SELECT lang, unnest(list_transform(range(1, len(ws) + 1), lambda i: ws[i:i])) AS p FROM lists UNION ALL
    SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i:i + 1])) FROM lists UNION ALL
    SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) FROM lists)),
  f AS (SELECT lang, size, phrase, count(*) AS f FROM words GROUP BY ALL),
  sizes AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
  c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND f >= 10),
  cuts AS (SELECT c.*, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
    FROM c, (SELECT unnest([1, 2]) AS k) WHERE k < size),
  scored AS (SELECT cuts.lang, cuts.size, cuts.phrase, a, k, h.f AS l, t.f AS r,
      (1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // (h.f::HUGEINT * t.f::HUGEINT) AS score
    FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = tail),
  best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  held AS (SELECT lang, phrase, max(a) AS within FROM (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE size = 3) GROUP BY ALL),
  kept AS (SELECT b.* FROM best b LEFT JOIN held USING (lang, phrase) WHERE b.size = 3 OR within IS NULL OR 100 * within < 50 * a),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
  SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""
