"""Language-model scoring with a weighted backoff automaton.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text after lower-casing A-Z, and one end token. The model backs off from
three words to one: a kept n-gram has the probability ``(c - DISCOUNT) / c(history)``, the rest of a history's mass goes to
the shorter history, and single words have ``(c + 0.1) / (N + 0.1 (V + 1))`` with the exact counts of the training rows,
where all unseen words share one place. N-grams that occur twice are kept, at every size; ``word_share`` and ``gram_share``
can ask for more than that.

The states of the automaton are the histories of kept n-grams, and a root. An arc is a kept n-gram: it leads from its history,
by its last word, to the longest history that the words read so far end in. A failure arc leads to the history without its
first word, at the price of its backoff weight. A text is scored in one traversal from left to right that carries the state:
failure arcs are taken until an arc reads the next word. The texts of a chunk are traversed side by side, a token of each at a
time, and the last few long ones one after the other.

The automaton is written as tables and cut into buckets whose number grows with the tokens; nothing of it is broadcast or
gathered. Texts are read once and written as numbers of words in chunks of about ``CHUNK`` bytes. A chunk sends its distinct words to
buckets, which add up counts and send back a number for each word. Then it sends two-word n-grams of words that occur twice,
as pairs of numbers, and gets the numbers of those that are kept; then three-word n-grams of which both parts are kept. So an
n-gram that cannot be kept is hardly ever sent, and one that is sent has one entry per chunk, however frequent it is. The
buckets write the arcs, and sums for the backoff weights of their histories, which are added up to the table of states. Last,
a chunk gets the weights of its states, puts together the part of the automaton that its texts can reach, and traverses it.
N-grams are told apart by numbers of words, not by hashes.

Defined cases: a null text counts as empty and is the end token alone. With no training rows every word is unseen and has
probability 1. Repeated rows and ids each get their row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import crc_fold, small_batches, text_or_empty

WORD_SHARE, GRAM_SHARE, LEAST, DISCOUNT = 0.0, 0.0, 2, 0.75
#: Text bytes of a chunk, and tokens of the corpus for each bucket.
CHUNK, BUCKET = 8 << 20, 1 << 20
#: Texts that are read a token of each at a time; fewer are read one after the other.
SIDE_BY_SIDE = 128
#: Ends a text; no byte of any UTF-8 text.
_END = b"\xff"
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Stands for what is no kept n-gram; and in place of a chunk, for a bucket's arcs and for its sums of backoff weights.
NONE, ARCS, SUMS = -1, -1, -2


def _pack(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes: high bytes are mostly zero."""
    planes = values.view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(blob: bytes, kind: type = np.int64) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(blob[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    return planes.reshape(8, n).T.copy().view(kind).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=0))


def _unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob))


def _hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64)


def _buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so words in order of their hashes lie by bucket."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def tokenized(texts: bytes) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of texts in order of their hashes, and the number of each token's word."""
    data = np.frombuffer(texts.replace(_END, b" " + _END + b" "), np.uint8)
    letter = ~_BLANK[data]
    edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    at = np.r_[0, np.cumsum(edge[1::2] - edge[::2])]
    tokens = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data[letter].tobytes())])
    coded = tokens.dictionary_encode()
    words: list[bytes] = coded.dictionary.to_pylist()
    by = np.argsort(_hashes(words), kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    return [words[i] for i in by.tolist()], rank[coded.indices.to_numpy()]


class Words:
    """The tokens of a chunk as numbers of its own words, in the order of the documents."""

    def __init__(self, code: np.ndarray, lens: np.ndarray, held: np.ndarray) -> None:
        self.code, self.lens = code, lens
        self.doc = np.repeat(np.arange(len(lens)), lens)
        self.train = np.repeat(~held, lens)
        self.size = int(code.max()) + 1


def _ranked(values: np.ndarray) -> np.ndarray:
    """Places of distinct values in their order."""
    out = np.empty(len(values), np.int64)
    out[np.argsort(values)] = np.arange(len(values))
    return out


class Grams:
    """The distinct n-grams that begin at ``starts``, by bucket: ``head``, the place of the history among the shorter ones, and
    ``code`` of the last word. ``first`` and ``second`` are the numbers of these."""

    def __init__(self, words: Words, starts: np.ndarray, head: np.ndarray, code: np.ndarray, first: np.ndarray, second: np.ndarray,
                 buckets: int) -> None:
        import pandas as pd

        wide = len(second)
        at, distinct = pd.factorize(head * wide + code)
        head, code = distinct // wide, distinct % wide
        mixed = (first[head].astype(np.uint64) ^ (second[code].astype(np.uint64) << np.uint64(32))) * _MIX
        bucket = ((mixed >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
        if buckets * len(first) * wide < 2**62:
            by = np.argsort((bucket * len(first) + _ranked(first)[head]) * wide + _ranked(second)[code])
        else:
            by = np.lexsort((second[code], first[head], bucket))
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        self.starts, self.at, self.head, self.code = starts, place[at], head[by], code[by]
        self.numbers, self.bounds = (first, second), np.searchsorted(bucket[by], np.arange(buckets + 1))

    def of_each(self, at_token: np.ndarray) -> np.ndarray:
        """What is known at the tokens where the n-grams begin; the same wherever one does."""
        out = np.zeros(len(self.head), np.int64)
        out[self.at] = at_token[self.starts]
        return out

    def at_tokens(self, of_each: np.ndarray, size: int) -> np.ndarray:
        out = np.full(size, NONE, np.int64)
        out[self.starts] = of_each[self.at]
        return out


def _two(words: Words, number: np.ndarray, buckets: int) -> Grams:
    """Two-word n-grams of the words that have a ``number``."""
    code, doc = words.code, words.doc
    ok = number[code] >= 0
    starts = np.flatnonzero(ok[:-1] & ok[1:] & (doc[:-1] == doc[1:]))
    return Grams(words, starts, code[starts], code[starts + 1], number, number, buckets)


def _three(words: Words, number: np.ndarray, two: Grams, found: np.ndarray, buckets: int) -> tuple[Grams, np.ndarray]:
    """Three-word n-grams of which both two-word parts are kept, and the places of their second parts."""
    place = two.at_tokens(np.where(found >= 0, np.arange(len(found)), NONE), len(words.code))
    starts = np.flatnonzero((place[:-1] >= 0) & (place[1:] >= 0))
    three = Grams(words, starts, place[starts], words.code[starts + 2], found, number, buckets)
    return three, three.of_each(np.r_[place[1:], NONE])


_PARTS = ("first", "second", "n", "n_first", "n_lower", "n_middle")
_SENT = pa.schema([("size", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), *[(c, pa.binary()) for c in _PARTS]])
_SENDS = "size int, bucket int, chunk bigint, " + ", ".join(f"{c} binary" for c in _PARTS)
_BACK = pa.schema([("to_chunk", pa.int64()), ("size", pa.int32()), ("bucket", pa.int32()), ("total", pa.int32()), *[(c, pa.binary()) for c in ("kept", "place", "n", "first", "second")]])
_BACKS = "to_chunk bigint, size int, bucket int, total int, kept binary, place binary, n binary, first binary, second binary"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = zip(*rows) if rows else [[]] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def _read(chunks: pa.Table | pa.RecordBatch, row: int = 0) -> tuple[int, Words]:
    chunk, codes, lens, held = (chunks.column(c)[row].as_py() for c in ("chunk", "codes", "lens", "held"))
    return chunk, Words(_unpack(codes), _unpack(lens), np.array(held, bool))


def _used(bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        yield b, int(bounds[b]), int(bounds[b + 1])


def _joined(words: list[bytes]) -> bytes:
    text = b"\n".join(words)
    return len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True)


def _split(blob: bytes) -> list[bytes]:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True).split(b"\n")


def _sent_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            chunk, words = _read(batch, row)
            names = _split(batch.column("words")[row].as_py())
            bounds = np.searchsorted(_buckets_of(_hashes(names), buckets), np.arange(buckets + 1))
            n = np.bincount(words.code, words.train, len(names)).astype(np.int64)
            rows = [(1, b, chunk, _joined(names[lo:hi]), None, _pack(n[lo:hi]), None, None, None) for b, lo, hi in _used(bounds)]
            yield from _table(rows, _SENT).to_batches()


def _told(chunk: int, size: int, bucket: int, kept: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple:
    """A chunk's n-grams of one bucket: which are kept, and the places in the bucket and counts of those."""
    return chunk, size, bucket, len(kept), np.packbits(kept).tobytes(), _pack_sorted(place[kept]), _pack(n[kept]), None, None


def _numbered_words(sent: pa.Table) -> pa.Table:
    """One bucket of words: those of training rows in a fixed order, and what each chunk needs to know of its own."""
    bucket = sent.column("bucket")[0].as_py()
    lists = [_split(x) for x in sent.column("first").to_pylist()]
    total: dict[bytes, int] = {}
    for words, n in zip(lists, sent.column("n").to_pylist()):
        for w, c in zip(words, _unpack(n).tolist()):
            total[w] = total.get(w, 0) + c
    known = sorted(w for w, c in total.items() if c)
    place = dict(zip((known[i] for i in np.argsort(_hashes(known), kind="stable").tolist()), range(len(known))))
    counts = np.array([total[w] for w in place], np.int64)
    rows = [(ARCS, 1, bucket, len(counts), None, None, _pack(counts), None, None)]
    for chunk, words in zip(sent.column("chunk").to_pylist(), lists):
        at = np.array([place.get(w, NONE) for w in words], np.int64)
        rows.append(_told(chunk, 1, bucket, at >= 0, at, counts[at] if len(counts) else at))
    return _table(rows, _BACK)


def _numbered_grams(sent: pa.Table, least: int, size: float, discount: float) -> pa.Table:
    """One bucket of n-grams: the kept ones in a fixed order, sums for their histories, and what each chunk needs to know."""
    order, bucket = sent.column("size")[0].as_py(), sent.column("bucket")[0].as_py()
    firsts = [_unpack_sorted(x) for x in sent.column("first").to_pylist()]
    first = np.concatenate(firsts)
    second, n, n_first, n_lower = (np.concatenate([_unpack(x) for x in sent.column(c).to_pylist()]) for c in ("second", "n", "n_first", "n_lower"))
    by = np.lexsort((second, first))
    new = np.r_[True, (first[by][1:] != first[by][:-1]) | (second[by][1:] != second[by][:-1])]
    starts = np.flatnonzero(new)
    counts = np.add.reduceat(n[by], starts)
    kept = counts >= least
    place, group = np.cumsum(kept) - 1, np.empty(len(by), np.int64)
    group[by] = np.cumsum(new) - 1
    one = by[starts[kept]]
    rows = []
    if len(one):
        rows.append((ARCS, order, bucket, len(one), None, None, _pack(counts[kept]), _pack_sorted(first[one]), _pack(second[one])))
        # What the history gives to its arcs, and what the shorter history would give to the same words.
        given = (counts[kept] - discount) / n_first[one]
        if order == 2:
            lower = (n_lower[one] + 0.1) / size
        else:
            n_middle = np.concatenate([_unpack(x) for x in sent.column("n_middle").to_pylist()])
            lower = (n_lower[one] - discount) / n_middle[one]
        cuts = np.flatnonzero(np.r_[True, first[one][1:] != first[one][:-1]])
        rows.append((SUMS, order - 1, bucket, len(cuts), None, _pack_sorted(first[one][cuts]), None, _pack(np.add.reduceat(given, cuts)), _pack(np.add.reduceat(lower, cuts))))
    at = 0
    for chunk, part in zip(sent.column("chunk").to_pylist(), firsts):
        mine = group[at:at + len(part)]
        rows.append(_told(chunk, order, bucket, kept[mine], place[mine], counts[mine]))
        at += len(part)
    return _table(rows, _BACK)


class Told:
    """What the buckets have sent back to a chunk."""

    def __init__(self, back: pa.Table, buckets: int) -> None:
        cols = (back.column(c).to_pylist() for c in ("size", "bucket", "kept", "place", "n", "total"))
        self.rows, self.buckets = {(s, b): rest for s, b, *rest in zip(*cols)}, buckets

    def of(self, size: int, bounds: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of n-grams dealt out within ``bounds``: place in the bucket times buckets, plus bucket."""
        number, n = np.full(total, NONE, np.int64), np.zeros(total, np.int64)
        for b, lo, hi in _used(bounds):
            if (size, b) in self.rows:
                kept, place, count, _ = self.rows[size, b]
                at = lo + np.flatnonzero(np.unpackbits(np.frombuffer(kept, np.uint8), count=hi - lo))
                number[at], n[at] = _unpack_sorted(place) * self.buckets + b, _unpack(count)
        return number, n

    def words(self, words: Words, fewest: float) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word that n-grams may have, and the count of each."""
        totals = {b: rest[3] for (s, b), rest in self.rows.items() if s == 1}
        bounds = np.cumsum([0, *(totals.get(b, 0) for b in range(self.buckets))])
        number, n = self.of(1, bounds, words.size)
        return np.where(n >= fewest, number, NONE), n

    def prices(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The states of one length among a chunk's histories, in order, and the prices of their failure arcs."""
        numbers, prices = [np.zeros(0, np.int64)], [np.zeros(0)]
        for (s, b), (kept, place, _, _) in self.rows.items():
            if s == -size:
                wanted = _unpack_sorted(self.rows[size, b][1]) * self.buckets + b
                numbers.append(wanted[np.unpackbits(np.frombuffer(kept, np.uint8), count=len(wanted)).astype(bool)])
                prices.append(_unpack(place, np.float64))
        number, price = np.concatenate(numbers), np.concatenate(prices)
        by = np.argsort(number)
        return number[by], price[by]


def _rows_of(chunk: int, size: int, words: Words, grams: Grams, n_first: np.ndarray, n_lower: np.ndarray, n_middle: np.ndarray | None) -> list[tuple]:
    first, second = grams.numbers[0][grams.head], grams.numbers[1][grams.code]
    n = np.bincount(grams.at, words.train[grams.starts], len(first)).astype(np.int64)
    return [(size, b, chunk, _pack_sorted(first[lo:hi]), *(None if x is None else _pack(x[lo:hi]) for x in (second, n, n_first, n_lower, n_middle)))
            for b, lo, hi in _used(grams.bounds)]


def _sent_two(chunks: pa.Table, back: pa.Table, buckets: int, fewest: float) -> pa.Table:
    if not len(chunks):
        return _SENT.empty_table()
    chunk, words = _read(chunks)
    number, n = Told(back, buckets).words(words, fewest)
    two = _two(words, number, buckets)
    return _table(_rows_of(chunk, 2, words, two, n[two.head], n[two.code], None), _SENT)


def _sent_three(chunks: pa.Table, back: pa.Table, buckets: int, fewest: float) -> pa.Table:
    if not len(chunks):
        return _SENT.empty_table()
    chunk, words = _read(chunks)
    told = Told(back, buckets)
    number, n = told.words(words, fewest)
    two = _two(words, number, buckets)
    found, n_two = told.of(2, two.bounds, len(two.head))
    three, rest = _three(words, number, two, found, buckets)
    return _table(_rows_of(chunk, 3, words, three, n_two[three.head], n_two[rest], n[two.head[rest]]), _SENT)


def _priced(asked: pa.Table, states: pa.Table, buckets: int) -> pa.Table:
    """The states among the histories of chunks in one bucket, and the prices of their failure arcs."""
    if not len(asked) or not len(states):
        return _BACK.empty_table()
    number, back = states.column("number").to_numpy(), states.column("back").to_numpy()
    by = np.argsort(number)
    number, back = number[by], back[by]
    rows = []
    for chunk, size, bucket, place in zip(*(asked.column(c).to_pylist() for c in ("chunk", "size", "bucket", "place"))):
        wanted = _unpack_sorted(place) * buckets + bucket
        at = np.minimum(np.searchsorted(number, wanted), len(number) - 1)
        state = number[at] == wanted
        rows.append((chunk, -size, bucket, len(wanted), np.packbits(state).tobytes(), _pack(back[at[state]]), None, None, None))
    return _table(rows, _BACK)


class Automaton:
    """The part of the automaton that a chunk's texts can reach. State 0 is the root."""

    def __init__(self, words: Words, back: pa.Table, buckets: int, fewest: float, size: float, discount: float) -> None:
        told, wide = Told(back, buckets), words.size
        number, self.n = told.words(words, fewest)
        two = _two(words, number, buckets)
        found, n_two = told.of(2, two.bounds, len(two.head))
        three, rest = _three(words, number, two, found, buckets)
        _, n_three = told.of(3, three.bounds, len(three.head))
        self.base = np.log10((self.n + 0.1) / size)
        (ones, price_one), (twos, price_two) = told.prices(1), told.prices(2)

        def states(of: np.ndarray, numbers: np.ndarray, first: int) -> np.ndarray:
            """State of each history, the root for what is none."""
            if not len(of):
                return np.zeros(len(numbers), np.int64)
            at = np.minimum(np.searchsorted(of, numbers), len(of) - 1)
            return np.where(of[at] == numbers, at + first, 0)

        word_state = states(ones, number, 1)
        two_state = states(twos, found, 1 + len(ones))
        # Two words that are no state lead where the last of them leads; that is also where a state of two words fails to.
        after_two = np.where(two_state > 0, two_state, word_state[two.code])
        fail = np.zeros(1 + len(ones) + len(twos), np.int64)
        fail[two_state] = word_state[two.code]
        fail[0] = 0
        self.back, self.fail, self.ones = np.r_[0.0, price_one, price_two], fail, len(ones)
        # Arcs, the root's first, in the order of the words: their weight, and where they lead.
        kept, last = np.flatnonzero(found >= 0), np.flatnonzero(n_three > 0)
        self.weight = np.r_[self.base, np.log10((n_two[kept] - discount) / self.n[two.head[kept]]),
                            np.log10((n_three[last] - discount) / n_two[three.head[last]])]
        self.to = np.r_[word_state, after_two[kept], after_two[rest[last]]]
        # The arc of each length that reads a token after the words before it; only lengths that have any.
        self.code, self.arcs = words.code, {}
        for grams, some, first in ((two, kept, wide), (three, last, wide + len(kept))):
            if len(some):
                arc = np.full(len(grams.head), NONE, np.int64)
                arc[some] = np.arange(first, first + len(some))
                back_by = 1 if grams is two else 2
                self.arcs[back_by + 1] = np.r_[np.full(back_by, NONE), grams.at_tokens(arc, len(words.code))[:-back_by]]

    def _read_by(self, state: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The arcs by which states read the tokens at ``at``; a state is that of the words before. The root reads any word."""
        two, three = (self.arcs[k][at] if k in self.arcs else NONE for k in (2, 3))
        return np.where(state > self.ones, three, np.where(state > 0, two, self.code[at]))

    def scores(self, lens: np.ndarray) -> np.ndarray:
        """One traversal of each text from the root. Texts are read side by side, a token of each at a time."""
        by = np.argsort(-lens, kind="stable")
        start, lens = (np.cumsum(lens) - lens)[by], lens[by]
        state, total = np.zeros(len(by), np.int64), np.zeros(len(by))
        step, live, shorter = 0, int(np.count_nonzero(lens)), -lens
        while live >= SIDE_BY_SIDE:
            at, now, sum_ = start[:live] + step, state[:live], total[:live]
            arc = self._read_by(now, at)
            fails = np.flatnonzero(arc < 0)
            while len(fails):
                sum_[fails] += self.back[now[fails]]
                now[fails] = self.fail[now[fails]]
                arc[fails] = self._read_by(now[fails], at[fails])
                fails = fails[arc[fails] < 0]
            sum_ += self.weight[arc]
            now[:] = self.to[arc]
            step += 1
            live = int(np.searchsorted(shorter, -step))
        for i in range(live):  # the rest of the few longest
            codes = self.code[start[i] + step:start[i] + lens[i]].tolist()
            total[i] = self.score(codes, int(start[i]) + step, int(state[i]), float(total[i]))
        out = np.empty(len(by))
        out[by] = total
        return out

    def score(self, codes: list[int], at: int = 0, state: int = 0, total: float = 0.0) -> float:
        """The traversal of one text whose words ``codes`` stand at place ``at`` of the chunk."""
        weight, to, back, fail, ones = memoryview(self.weight), memoryview(self.to), memoryview(self.back), memoryview(self.fail), self.ones
        none = [NONE] * len(codes)
        twos, threes = (self.arcs[k][at:at + len(codes)].tolist() if k in self.arcs else none for k in (2, 3))
        for word, two, three in zip(codes, twos, threes):
            arc = three if state > ones else two if state else word
            while arc < 0:
                total += back[state]
                state = fail[state]
                arc = two if state else word
            total += weight[arc]
            state = to[arc]
        return total


def _scored(chunks: pa.Table, back: pa.Table, buckets: int, fewest: float, size: float, discount: float, schema: pa.Schema) -> pa.Table:
    if not len(chunks):
        return schema.empty_table()
    _, words = _read(chunks)
    pa.default_memory_pool().release_unused()  # of earlier stages
    automaton = Automaton(words, back, buckets, fewest, size, discount)
    del back
    docs = len(words.lens)
    known = np.bincount(words.doc, automaton.n[words.code] > 0, docs).astype(np.int64)
    base = np.bincount(words.doc, automaton.base[words.code], docs)
    scores = automaton.scores(words.lens)
    flat = lambda c: pa.concat_arrays(chunks.column(c).chunks).flatten()
    return pa.table([flat("keys"), flat("held"), pa.array(words.lens), pa.array(known), pa.array(base), pa.array(scores)], schema=schema)


def _chunks(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per chunk: its documents as numbers of its own words, the words, and the documents' keys and folds."""
    from pyspark import TaskContext

    nth = TaskContext.get().partitionId() << 32
    texts, held, keys, length = [], [], [], 0

    def row() -> pa.RecordBatch:
        words, code = tokenized(b"".join(texts))
        ends = np.flatnonzero(code == words.index(_END))
        key = pa.concat_arrays(keys)
        values = [nth, _pack(code), _pack(np.diff(ends, prepend=-1)), _joined(words), None, held, len(code)]
        arrays = [pa.array([v], f.type) for v, f in zip(values, schema)]
        arrays[4] = pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key).cast(schema.field("keys").type)
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        for at, (text, out) in enumerate(zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("held").to_pylist())):
            texts += [text.lower(), _END]  # of bytes: ASCII only
            held.append(out)
            keys.append(batch.column("key").slice(at, 1))
            length += len(text) + 1
            if length >= size:
                yield row()
                nth, texts, held, keys, length = nth + 1, [], [], [], 0
    if held:
        yield row()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for size, place, first, second in zip(*(batch.column(c).to_pylist() for c in ("size", "place", "first", "second"))):
            number = _unpack_sorted(place)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                np.full(len(number), size, np.int32), number, _unpack(first, np.float64), _unpack(second, np.float64))],
                names=["size", "number", "given", "lower"])


def states_of(back: DataFrame) -> DataFrame:
    """The states of the automaton: (size, number, back), a history with the price of its failure arc."""
    sums = back.where(F.col("to_chunk") == SUMS).select("size", "place", "first", "second").mapInArrow(
        _sums, "size int, number bigint, given double, lower double")
    rest = lambda c: F.greatest(1 - F.sum(c), F.lit(1e-12))
    return sums.groupBy("size", "number").agg(F.log10(rest("given") / rest("lower")).alias("back"))


def _arcs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for size, bucket, n, first, second in zip(*(batch.column(c).to_pylist() for c in ("size", "bucket", "n", "first", "second"))):
            count = _unpack(n)
            none = np.full(len(count), NONE)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                np.full(len(count), size, np.int32), np.arange(len(count)) * buckets + bucket,
                none if first is None else _unpack_sorted(first), none if second is None else _unpack(second), count)],
                names=["size", "number", "first", "second", "n"])


def arcs_of(back: DataFrame, buckets: int) -> DataFrame:
    """The arcs of the automaton: (size, number, first, second, n), an n-gram as its history's number and its last word's."""
    return back.where(F.col("to_chunk") == ARCS).select("size", "bucket", "n", "first", "second").mapInArrow(
        lambda b: _arcs(b, buckets), "size int, number bigint, first bigint, second bigint, n bigint")


def _word_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [_unpack(x) for x in batch.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([int(c.sum()) for c in counts], pa.int64()), pa.array([len(c) for c in counts], pa.int64())], names=["n", "v"])


class Learned(NamedTuple):
    """The written chunks, what the buckets said of words and n-grams of two and three words, the states, and the sizes."""

    chunks: DataFrame
    one: DataFrame
    two: DataFrame
    three: DataFrame
    states: DataFrame
    buckets: int
    tokens: int
    size: float
    fewest: float

    def arcs(self) -> DataFrame:
        """The arcs of the automaton: (size, number, first, second, n), by the numbers of history and last word."""
        return arcs_of(self.one.unionByName(self.two).unionByName(self.three), self.buckets)

    def with_chunks(self, back: DataFrame, fn, schema) -> DataFrame:
        told = back.where(F.col("to_chunk") >= 0).drop("first", "second").groupBy("to_chunk")
        return self.chunks.drop("words").groupBy("chunk").cogroup(told).applyInArrow(fn, schema)


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, held_out: int = 0,
          word_share: float = WORD_SHARE, gram_share: float = GRAM_SHARE, discount: float = DISCOUNT,
          chunk: int = CHUNK, bucket: int = BUCKET) -> Learned:
    """The automaton of the rows outside fold ``held_out``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(docs.sparkSession)
    kind = docs.select(key).schema[0].dataType
    rows = docs.select(F.col(key).alias("key"), (crc_fold(key, folds) == held_out).alias("held"), text_or_empty(text).alias("text"))
    shape = T.StructType([T.StructField(n, t) for n, t in (
        ("chunk", T.LongType()), ("codes", T.BinaryType()), ("lens", T.BinaryType()), ("words", T.BinaryType()),
        ("keys", T.ArrayType(kind)), ("held", T.ArrayType(T.BooleanType())), ("tokens", T.LongType()))])
    arrow = to_arrow_schema(shape)
    chunks = materialize(rows.mapInArrow(lambda b: _chunks(b, chunk, arrow), shape), "chunks")
    buckets = max(1, -(-(chunks.agg(F.sum("tokens")).first()[0] or 0) // bucket))

    def by_bucket(sent: DataFrame, fn, name: str) -> DataFrame:
        return materialize(sent.groupBy("size", "bucket").applyInArrow(fn, _BACKS), name)

    one = by_bucket(chunks.mapInArrow(lambda b: _sent_words(b, buckets), _SENDS), _numbered_words, "words")
    n, v = one.where(F.col("to_chunk") == ARCS).select("n").mapInArrow(_word_totals, "n bigint, v bigint").agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    size = n + 0.1 * (v + 1)
    least = max(LEAST, int(np.ceil(gram_share * n)))
    fewest = max(float(least), word_share * n)
    number = lambda t: _numbered_grams(t, least, size, discount)
    made = Learned(chunks, one, one, one, one, buckets, int(n), size, fewest)
    two = by_bucket(made.with_chunks(one, lambda c, b: _sent_two(c, b, buckets, fewest), _SENDS), number, "two-words")
    three = by_bucket(made.with_chunks(one.unionByName(two), lambda c, b: _sent_three(c, b, buckets, fewest), _SENDS), number, "three-words")
    states = materialize(states_of(two.unionByName(three)), "states")
    return made._replace(two=two, three=three, states=states)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, held_out: int = 0,
          word_share: float = WORD_SHARE, gram_share: float = GRAM_SHARE, discount: float = DISCOUNT,
          chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learned from the rows outside fold ``held_out``; scores are log10 probabilities.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    made = learn(docs, key, text, folds, held_out, word_share, gram_share, discount, chunk, bucket)
    buckets, size, fewest, kind = made.buckets, made.size, made.fewest, made.chunks.schema["keys"].dataType.elementType
    keyed = made.states.select(F.col("size").alias("of_size"), F.pmod("number", F.lit(buckets)).cast("int").alias("of_bucket"), "number", "back")
    known = made.one.unionByName(made.two)
    asked = known.where(F.col("to_chunk") >= 0).select("size", "bucket", F.col("to_chunk").alias("chunk"), "place")
    prices = asked.groupBy("size", "bucket").cogroup(keyed.groupBy("of_size", "of_bucket")).applyInArrow(
        lambda a, s: _priced(a, s, buckets), _BACKS)

    found = T.StructType([T.StructField(n, t) for n, t in (
        ("doc_id", kind), ("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()),
        ("base_score", T.DoubleType()), ("score", T.DoubleType()))])
    answer = to_arrow_schema(found)
    scored = made.with_chunks(known.unionByName(made.three).unionByName(prices),
                              lambda c, b: _scored(c, b, buckets, fewest, size, discount, answer), found)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(made.tokens).cast("bigint").alias("train_tokens"),
                         "base_score", "score")
