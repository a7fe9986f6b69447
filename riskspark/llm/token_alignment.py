"""Alignment of two tokenizers' tokens by inverted pair bitmaps.

A text, with one space before it, is encoded by a byte-level BPE model (A) and by a SentencePiece model (B, which adds that
space itself). Byte offsets at which tokens of both end cut the tokens into groups, and the two tokens that end there are
linked. For each pair of ids that is ever linked there is a posting: in each chunk of documents

* a bitmap of the documents in which the pair is linked, and
* multiplicity planes: bitmap ``k`` has the documents whose further links (those beyond the first) have bit ``k`` set.

A bitmap is kept as sorted 16-bit document numbers or as plain bits, whichever is smaller. Chunks hold different documents,
so the bitmaps of a pair merge by standing side by side: document counts are popcounts of the bitmaps, link counts are these
and the planes' popcounts times their place values. The counts of a chunk's pairs come back to it by a join on the pair, and
the chunk's postings hand them to its documents.

Nothing of the pairs is broadcast or gathered; a pair has one row per chunk at most, however often it is linked. The two
model files have a fixed size and are broadcast as bytes.

Defined cases: a null or empty text, and a text whose tokens of either model do not give its bytes back, has no tokens: zeros
and an empty ``groups_sha256``. Null and repeated ids and repeated rows each get their row. An empty table gives no rows.
Special tokens' strings inside texts are plain text. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import BATCH_ROWS, small_batches, text_or_empty

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Text bytes of a chunk, and its documents at most: their numbers have 16 bits.
CHUNK_BYTES, CHUNK_DOCS = 8 << 20, 1 << 16
#: A pair is one number: id of A times this, plus id of B.
STRIDE = 1 << 24


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode("utf-8")


class Tokenizers:
    """Both models, the bytes of their tokens, and the tokens' lengths."""

    def __init__(self, byte_model: bytes, piece_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(byte_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters, vocab = byte_letters(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode("utf-8")
        self.bytes_b = [_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.len_a, self.len_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        most = max(len(self.bytes_a), len(self.bytes_b))
        # One number per id: its decimal digits as bytes from the left, zeros, and room for a separator.
        texts = [str(i).encode() for i in range(most)]
        self.digits = np.frombuffer(b"".join([t.ljust(8, b"\0") for t in texts]), "<u8")
        self.widths = np.array([len(t) for t in texts], np.int64)

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both models; none for texts that either does not give back."""
        out: list[tuple[list[int], list[int]]] = []
        full = [t for t in texts if t]
        spaced = [" " + t for t in full]
        found = zip(spaced, self.a.encode_batch_fast(spaced, add_special_tokens=False), self.b.encode(full, num_threads=1) if full else [])
        pairs = iter([self._checked(s, x.ids, y) for s, x, y in found])
        for t in texts:
            out.append(next(pairs) if t else ([], []))
        return out

    def _checked(self, spaced: str, a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
        whole, of_a, of_b = spaced.encode("utf-8"), self.bytes_a, self.bytes_b
        same = b"".join([of_a[i] for i in a]) == whole and b"".join([of_b[i] for i in b]) == whole
        return (a, b) if same else ([], [])


def _tokenizers(models: Broadcast) -> Tokenizers:
    held = models.value  # one dict per worker process, so the models are built once in it
    if "built" not in held:
        held["built"] = Tokenizers(held["a"], held["b"])
    return held["built"]


class Aligned:
    """The tokens of several documents end to end, and where both models' tokens end together."""

    def __init__(self, made: Tokenizers, ids: list[tuple[list[int], list[int]]]) -> None:
        self.made, self.docs = made, len(ids)
        self.n_a, self.n_b = (np.array([len(x[i]) for x in ids], np.int64) for i in (0, 1))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *[np.array(x[i], np.int64) for x in ids]]) for i in (0, 1))
        ends_a, ends_b = np.cumsum(made.len_a[self.a]), np.cumsum(made.len_b[self.b])
        at = np.searchsorted(ends_b, ends_a)
        self.last_a = np.flatnonzero(ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a) if len(ends_b) else np.zeros(0, np.int64)
        self.last_b = at[self.last_a]
        self.doc = np.repeat(np.arange(self.docs), self.n_a)[self.last_a]
        self.n_groups = np.bincount(self.doc, minlength=self.docs)

    def group_texts(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each document."""
        end_a, end_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        end_a[self.last_a], end_b[self.last_b] = 1, 1
        group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
        before_b = np.r_[0, self.last_b + 1]  # tokens of B in earlier groups
        comma, bar, semicolon = (np.uint64(ord(c) << 56) for c in ",|;")
        cells = np.empty(len(self.a) + len(self.b), "<u8")
        cells[np.arange(len(self.a)) + before_b[group_a]] = self.made.digits[self.a] | np.where(end_a, bar, comma)
        cells[np.arange(len(self.b)) + self.last_a[group_b] + 1] = self.made.digits[self.b] | np.where(end_b, semicolon, comma)
        to_a, to_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        tokens = to_a + to_b
        cells[tokens[tokens > 0] - 1] &= np.uint64((1 << 56) - 1)  # nothing after a document's last group
        up_to = lambda ids: np.r_[0, np.cumsum(self.made.widths[ids])]
        ends = up_to(self.a)[to_a] + up_to(self.b)[to_b] + tokens - np.cumsum(self.n_a + self.n_b > 0)
        flat = cells.tobytes().translate(None, b"\0")
        return [flat[lo:hi] for lo, hi in zip([0, *ends.tolist()], ends.tolist())]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pair and document of every link."""
        return self.a[self.last_a] * STRIDE + self.b[self.last_b], self.doc


def packed(owner: np.ndarray, doc: np.ndarray, owners: int, docs: int) -> bytes:
    """Bitmaps of ``owners`` pairs over ``docs`` documents from (owner, doc) sorted by both: sizes, then bits, then numbers."""
    sizes = np.bincount(owner, minlength=owners)
    dense = sizes * 16 > docs
    of_dense = dense[owner]
    bits = np.zeros((int(dense.sum()), docs), np.uint8)
    bits[(np.cumsum(dense) - 1)[owner[of_dense]], doc[of_dense]] = 1
    return b"".join([sizes.astype(np.uint32).tobytes(), np.packbits(bits, axis=1).tobytes(), doc[~of_dense].astype(np.uint16).tobytes()])


def unpacked(blob: bytes, owners: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The (owner, doc) of ``packed``, in any order."""
    sizes = np.frombuffer(blob, np.uint32, owners).astype(np.int64)
    dense, wide = np.flatnonzero(sizes * 16 > docs), -(-docs // 8)
    bits = np.frombuffer(blob, np.uint8, len(dense) * wide, 4 * owners).reshape(len(dense), wide)
    row, doc = np.nonzero(np.unpackbits(bits, axis=1, count=docs))
    sparse = np.where(sizes * 16 > docs, 0, sizes)
    rest = np.frombuffer(blob, np.uint16, int(sparse.sum()), 4 * owners + len(dense) * wide)
    return np.r_[dense[row], np.repeat(np.arange(owners), sparse)], np.r_[doc, rest.astype(np.int64)]


def popcounts(blob: bytes, owners: int, docs: int) -> np.ndarray:
    """Documents in each bitmap of ``packed``: counted bits, or how many numbers there are."""
    sizes = np.frombuffer(blob, np.uint32, owners).astype(np.int64)
    dense, wide = np.flatnonzero(sizes * 16 > docs), -(-docs // 8)
    bits = np.frombuffer(blob, np.uint8, len(dense) * wide, 4 * owners).reshape(len(dense), wide)
    sizes[dense] = np.bitwise_count(bits).sum(axis=1)
    return sizes


def postings(pair: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, list[bytes]]:
    """The pairs of a chunk in order; their bitmap and the planes of their further links."""
    key, times = np.unique(pair * CHUNK_DOCS + doc, return_counts=True)
    pairs, owner = np.unique(key // CHUNK_DOCS, return_inverse=True)
    doc, more = key % CHUNK_DOCS, times - 1
    planes = [packed(owner, doc, len(pairs), docs)]
    for k in range(int(more.max(initial=0)).bit_length()):
        has = (more >> k & 1).astype(bool)
        planes.append(packed(owner[has], doc[has], len(pairs), docs))
    return pairs, planes


def counts_of(planes: list[bytes], owners: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and links of each pair."""
    counts = [popcounts(p, owners, docs) for p in planes]
    return counts[0], counts[0] + sum((c << k for k, c in enumerate(counts[1:])), np.zeros(owners, np.int64))


def _places(planes: list[bytes], owners: int, docs: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(weight, pair's place, document): each bitmap with what one of its bits counts."""
    for k, blob in enumerate(planes):
        yield (1 << max(0, k - 1), *unpacked(blob, owners, docs))


def _segments(batches: Iterator[pa.RecordBatch], models: Broadcast, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per chunk: its documents' figures and its postings."""
    from pyspark import TaskContext

    made, nth = _tokenizers(models), TaskContext.get().partitionId() << 32
    keys, texts, held = [], [], 0

    def row() -> pa.RecordBatch:
        parts = []
        for lo in range(0, len(texts), BATCH_ROWS):
            parts.append(Aligned(made, made.encode(texts[lo:lo + BATCH_ROWS])))
        pair, doc, shas, at = [], [], [], 0
        for p in parts:
            x, y = p.links()
            pair.append(x)
            doc.append(y + at)
            shas += [hashlib.sha256(t).hexdigest() if t else "" for t in p.group_texts()]
            at += p.docs
        pairs, planes = postings(np.concatenate(pair), np.concatenate(doc), at)
        n_docs, n_links = counts_of(planes, len(pairs), at)
        flat = lambda name: np.concatenate([getattr(p, name) for p in parts]).astype(np.int64)
        key = pa.concat_arrays(keys)
        values = [nth, None, flat("n_a"), flat("n_b"), flat("n_groups"), shas, pairs, n_docs, n_links, planes]
        arrays = [pa.array([v], f.type) for v, f in zip(values, schema)]
        arrays[1] = pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key).cast(schema.field("keys").type)
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        for at, text in enumerate(batch.column("text").to_pylist()):
            keys.append(batch.column("key").slice(at, 1))
            texts.append(text)
            held += len(text)
            if held >= size or len(texts) == CHUNK_DOCS:
                yield row()
                nth, keys, texts, held = nth + 1, [], [], 0
    if texts:
        yield row()


def segments(docs: DataFrame, key: str = "doc_id", text: str = "text", byte_model: str = BYTE_MODEL,
             piece_model: str = PIECE_MODEL, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The written index: a row per chunk with its documents' figures and the postings of its pairs."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.select(key).schema[0].dataType
    files = {}
    for name, path in (("a", byte_model), ("b", piece_model)):
        with open(path, "rb") as f:
            files[name] = f.read()
    models = spark.sparkContext.broadcast(files)
    longs = T.ArrayType(T.LongType())
    shape = T.StructType([T.StructField(n, t) for n, t in (
        ("chunk", T.LongType()), ("keys", T.ArrayType(kind)), ("n_a", longs), ("n_b", longs), ("n_groups", longs),
        ("groups_sha256", T.ArrayType(T.StringType())), ("pairs", longs), ("documents", longs), ("links", longs),
        ("planes", T.ArrayType(T.BinaryType())))])
    arrow = to_arrow_schema(shape)
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    return materialize(rows.mapInArrow(lambda b: _segments(b, models, chunk_bytes, arrow), shape), "segments")


def _chunk_pairs(index: DataFrame) -> DataFrame:
    return index.select("chunk", F.inline(F.arrays_zip("pairs", "documents", "links"))).withColumnRenamed("pairs", "pair")


def pair_counts(index: DataFrame) -> DataFrame:
    """(pair, a, b, documents, links) over the whole corpus."""
    total = _chunk_pairs(index).groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    return total.select("pair", (F.shiftright("pair", STRIDE.bit_length() - 1)).alias("a"),
                        (F.col("pair").bitwiseAND(STRIDE - 1)).alias("b"), "documents", "links")


def _returned(index: pa.Table, scores: pa.Table, schema: pa.Schema) -> pa.Table:
    """The counts of a chunk's pairs, handed to its documents by its postings."""
    if not len(index):
        return schema.empty_table()
    flat = lambda name: pa.concat_arrays(index.column(name).chunks).flatten()
    docs, pairs = len(flat("keys")), flat("pairs").to_numpy()
    at = np.searchsorted(pairs, scores.column("pair").to_numpy())
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    count[at], best[at] = scores.column("links").to_numpy(), scores.column("best").to_numpy()
    sums, bests = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    for weight, owner, doc in _places(index.column("planes")[0].as_py(), len(pairs), docs):
        np.add.at(sums, doc, weight * count[owner])
        np.add.at(bests, doc, weight * best[owner])
    n_groups = flat("n_groups")
    return pa.table([flat("keys"), flat("n_a"), flat("n_b"), n_groups, n_groups, pa.array(bests), pa.array(sums),
                     flat("groups_sha256")], schema=schema)


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", byte_model: str = BYTE_MODEL,
          piece_model: str = PIECE_MODEL, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    from pyspark.sql.pandas.types import to_arrow_schema

    index = segments(docs, key, text, byte_model, piece_model, chunk_bytes)
    counts = materialize(pair_counts(index).select("pair", "b", "links"), "pair-counts")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    scored = counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).cast("bigint").alias("best"))
    back = _chunk_pairs(index).select(F.col("chunk").alias("of_chunk"), "pair").join(scored, "pair")
    kind = index.schema["keys"].dataType.elementType
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    shape = T.StructType([T.StructField("doc_id", kind), *[T.StructField(n, T.LongType()) for n in names],
                          T.StructField("groups_sha256", T.StringType())])
    answer = to_arrow_schema(shape)
    told = index.select("chunk", "keys", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "planes")
    return told.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(lambda i, s: _returned(i, s, answer), shape)
