"""Removal of repeated passages with an enhanced suffix array.

Texts are UTF-8 bytes. A byte is removed if a run of ``least`` bytes that covers it also starts earlier: in a document with a
smaller id, or earlier in the same document. Runs are judged on the input, and overlapping ones count.

1. *Anchors.* Every run of ``least`` bytes holds an anchor, the place of the smallest hash of ``GRAM`` bytes in it, which
   depends on the run's bytes only. So all copies of a run meet at equal anchors. The bytes around an anchor in which runs
   with that anchor lie are its context. Anchors are found in each task, and of equal contexts only the first of a task is
   sent on: the others are covered. So a passage that a third of all documents share is sent once a task.
2. *Classes.* By anchor hash, equal contexts form a class, and all but the first of a class are covered. An anchor hash with one
   class needs no more. Of others, the contexts of the classes' first places are asked for.
3. *Suffix arrays.* The contexts of an anchor hash are in one group. Suffixes whose first ``least`` bytes never repeat, or repeat
   after one and the same byte only, start no maximal repeat and are left out. The others are sorted to a suffix array with
   the common prefixes of neighbours, and one scan with a stack lists the tree of common-prefix intervals. An interval is a repeat of all the places in it; it is maximal if the bytes before them differ. All its places but
   the first are covered.
   A group of more than ``GROUP`` contexts does not go to one task: its runs are sent by the hash of the run itself, again
   only the first of a task, and all but the first are covered.
4. *Spans* return to their documents and are cut out.

Hashes of anchors and contexts have 64 bits each and are only ever compared together; runs of large groups have two of them.

Defined cases: a null text counts as empty; texts below ``least`` bytes lose nothing. Null ids order behind all others. Rows
that repeat id and text are the same document: neither is earlier than the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import small_batches, text_or_empty

LEAST = 100
GRAM = 32
#: Contexts of an anchor hash that one suffix array holds.
GROUP = 2000
#: Bytes of text to a bucket; the number of buckets follows from the size of the table.
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 32
#: Bytes hashed at once, anchors of a task put together before they are sent, and context bytes of one suffix array.
_PIECE, _HELD, _ARRAY = 1 << 20, 1_000_000, 1 << 19
_NULL_ID = 2**63 - 1
_MAX = np.uint64(2**64 - 1)
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

#: Rows on their way: packed columns of equal length, but for ``text``. What they mean depends on ``kind``.
_PACKED = "bucket int, kind int, ids binary, marks binary, a binary, b binary, c binary, text binary"
_ANCHORS, _SPANS, _ASKED, _CONTEXTS, _RUNS = range(5)


def _pack(bucket: int, kind: int, ids, marks, a, b, c=None, text: bytes | None = None) -> tuple:
    return (bucket, kind, ids.astype("<i8").tobytes(), marks.astype("<i4").tobytes(), a.tobytes(), b.tobytes(),
            None if c is None else c.tobytes(), text)


def _unpack(rows: pd.DataFrame, a: str, b: str, c: str | None = None) -> list[np.ndarray]:
    kinds = [("ids", "<i8"), ("marks", "<i4"), ("a", a), ("b", b), *([("c", c)] if c else [])]
    return [np.frombuffer(b"".join(map(bytes, rows[name])), kind) for name, kind in kinds]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split()[0] for f in _PACKED.split(", ")])


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its rows."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        yield int(buckets[part[0]]), part


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """True where a new group of equal keys begins."""
    new = np.zeros(len(sorted_keys[0]), bool)
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    new[:1] = True
    return new


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    return values if done == width else pick(values[:len(values) - (width - done)], values[width - done:])


def anchors(data: bytes, bounds: list[tuple[int, int]], least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of the texts at ``bounds`` in ``data``."""
    width, count = least - GRAM + 1, len(data) - GRAM + 1
    if count < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = words[:count] * _C[0]
    for i, mixer in zip((8, 16, 24), _C[1:]):
        h ^= h >> np.uint64(31)
        h += words[i:i + count]
        h *= mixer
    h ^= h >> np.uint64(32)
    inside = np.zeros(count, bool)
    for start, end in bounds:
        inside[start:max(start, end - GRAM + 1)] = True
    h[~inside] = _MAX
    lowest = _sliding(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    highest = _sliding(np.concatenate((edge, lowest, edge)), width, np.maximum)
    places = np.flatnonzero((highest == h) & inside)
    return places, h[places]


def _pieces(texts: list[bytes], least: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, start, end) of about a piece; a longer text is cut with overlaps that hold every run."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text) - least + 1), _PIECE):
            end = min(len(text), start + _PIECE + least - 1)
            if end - start < least:
                continue
            if group and size + end - start > _PIECE:
                yield group
                group, size = [], 0
            group.append((i, start, end))
            size += end - start
    if group:
        yield group


class _Task:
    """Anchors of one task, put together and reduced before they are sent."""

    def __init__(self, buckets: int, least: int):
        self.buckets, self.least, self.held = buckets, least, []
        self.size = 0

    def add(self, ids: np.ndarray, marks: np.ndarray, texts: list[bytes]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_64_intdigest as digest

        reach = self.least - GRAM
        for group in _pieces(texts, self.least):
            data = b"".join(texts[i][a:b] for i, a, b in group)
            ends = np.cumsum([b - a for _, a, b in group])
            begins = ends - [b - a for _, a, b in group]
            places, hashes = anchors(data, list(zip(begins.tolist(), ends.tolist())), self.least)
            piece = np.searchsorted(ends, places, side="right")
            text = np.array([i for i, _, _ in group])[piece]
            at = places - begins[piece] + np.array([a for _, a, _ in group])[piece]
            lengths = np.array([len(t) for t in texts])[text]
            left, right = np.maximum(at - reach, 0), np.minimum(at + self.least, lengths)
            fits = right - left >= self.least
            text, at, hashes, left, right = (x[fits] for x in (text, at, hashes, left, right))
            contexts = np.array([digest(texts[i][a:b], p - a) for i, a, b, p in zip(
                text.tolist(), left.tolist(), right.tolist(), at.tolist())], np.uint64)
            self.held.append((hashes, contexts, ids[text], marks[text], at.astype(np.int32)))
            self.size += len(at)
            if self.size >= _HELD:
                yield self.send()

    def send(self) -> pd.DataFrame:
        if not self.held:
            return _frame([])
        h, c, ids, marks, at = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        first, covered = _first_places(h, c, ids, marks, at)
        rows = []
        for bucket, part in _by_bucket((h[first] % np.uint64(self.buckets)).astype(np.int64)):
            part = first[part]
            rows.append(_pack(bucket, _ANCHORS, ids[part], marks[part], h[part], c[part], at[part]))
        rows += _spans(ids[covered], marks[covered], at[covered], self.least, self.buckets, self.buckets)
        return _frame(rows)


def _first_places(h, c, ids, marks, at) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each (h, c), and of those that come after it. Of equal documents one is kept."""
    order = np.lexsort((marks, at, ids, c, h))
    h, c, ids, at = h[order], c[order], ids[order], at[order]
    new = _starts(h, c)
    lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.zeros(0, np.int64)
    later = (ids != ids[lead]) | (at != at[lead])
    other = ~new & ~later & (marks[order] != marks[order][lead])  # texts that share an id
    return order[new | other], order[later]


def _spans(ids, marks, at, least: int, buckets: int, offset: int = 0) -> list[tuple]:
    """Packed spans of the contexts at the given anchors, overlapping ones merged."""
    return _runs(ids, marks, np.maximum(at - (least - GRAM), 0), at + least, buckets, offset)


def _runs(ids, marks, starts, ends, buckets: int, offset: int = 0) -> list[tuple]:
    order = np.lexsort((starts, marks, ids))
    ids, marks, starts, ends = ids[order], marks[order], starts[order], ends[order]
    new = _starts(ids, marks)
    if len(order):  # ends grow with starts: spans are of one length, but for those cut off at the start of a text
        new[1:] |= starts[1:] > ends[:-1]
    lead = np.flatnonzero(new)
    ids, marks, starts = ids[lead], marks[lead], starts[lead]
    ends = np.maximum.reduceat(ends, lead) if len(lead) else ends
    return [_pack(bucket + offset, _SPANS, ids[p], marks[p], starts[p].astype("<i4"), ends[p].astype("<i4"))
            for bucket, p in _by_bucket(_home(ids, marks, buckets))]


#: Prime and factor that mix ids; the products fit into 64 bits here and in Spark.
_PRIME, _FACTOR = 2**31 - 1, 48271


def _home(ids: np.ndarray, marks: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in which a document's spans meet its text; texts that share an id are spread by their marks."""
    mixed = ids.astype(np.int64) % _PRIME * _FACTOR + marks.astype(np.int64) % _PRIME
    return mixed % _PRIME * _FACTOR % _PRIME % buckets


def _home_column(id_: str, mark: str, buckets: int) -> Column:
    mixed = F.pmod(F.col(id_), F.lit(_PRIME)) * _FACTOR + F.pmod(F.col(mark).cast("bigint"), F.lit(_PRIME))
    return (mixed % _PRIME * _FACTOR % _PRIME % buckets).cast("int")


def _find(frames: Iterator[pd.DataFrame], buckets: int, least: int) -> Iterator[pd.DataFrame]:
    task = _Task(buckets, least)
    for frame in frames:
        texts = [t.encode("utf-8", "surrogatepass") for t in frame["text"]]
        yield from task.add(frame["id"].to_numpy(np.int64), frame["mark"].to_numpy(np.int64), texts)
    yield task.send()


def _classify(frame: pd.DataFrame, buckets: int, least: int, group: int) -> pd.DataFrame:
    """Anchors of one bucket: covered places, and the places whose contexts are asked for."""
    spans = frame[frame["kind"] == _SPANS]
    rows = [(r.bucket - buckets, *r[1:]) for r in spans.itertuples(index=False)]
    ids, marks, h, c, at = _unpack(frame[frame["kind"] == _ANCHORS], "<u8", "<u8", "<i4")
    order = np.argsort(h, kind="stable")  # most anchors occur once
    new = _starts(h[order])
    again = ~(new & np.r_[new[1:], True]) if len(order) else new
    ids, marks, h, c, at = (x[order][again] for x in (ids, marks, h, c, at))
    first, covered = _first_places(h, c, ids, marks, at)
    rows += _spans(ids[covered], marks[covered], at[covered], least, buckets)
    ids, marks, h, c, at = (x[first] for x in (ids, marks, h, c, at))
    new = _starts(h)
    size = np.diff(np.r_[np.flatnonzero(new), len(h)])[np.cumsum(new) - 1] if len(h) else np.zeros(0, np.int64)
    asked = size > 1
    ids, marks, h, at, size = (x[asked] for x in (ids, marks, h, at, size))
    for bucket, p in _by_bucket(_home(ids, marks, buckets)):
        rows.append(_pack(bucket, _ASKED, ids[p], marks[p], h[p], at[p].astype("<i4"), (size[p] > group).astype("<i4")))
    return _frame(rows)


def _ids_of(docs: pd.DataFrame) -> dict[tuple[int, int], bytes]:
    return {(i, m): t.encode("utf-8", "surrogatepass") for i, m, t in zip(docs["id"], docs["mark"], docs["text"])}


def _contexts(docs: pd.DataFrame, asked: pd.DataFrame, buckets: int, least: int) -> pd.DataFrame:
    """Cuts out the contexts asked for; those of large groups leave as the hashes of their runs."""
    from xxhash import xxh3_128_intdigest as digest

    texts = _ids_of(docs)
    ids, marks, h, at, large = _unpack(asked, "<u8", "<i4", "<i4")
    reach, rows = least - GRAM, []
    small = np.flatnonzero(large == 0)
    for bucket, p in _by_bucket((h[small] % np.uint64(buckets)).astype(np.int64)):
        p = small[p]
        found = [texts[i, m][max(0, a - reach):a + least] for i, m, a in zip(ids[p].tolist(), marks[p].tolist(), at[p].tolist())]
        shape = np.array([[max(0, a - reach), len(f)] for a, f in zip(at[p].tolist(), found)], "<i4")
        rows.append(_pack(bucket, _CONTEXTS, ids[p], marks[p], h[p], shape, text=b"".join(found)))
    big = np.flatnonzero(large)
    runs = [(ids[j], marks[j], s, digest(texts[ids[j], marks[j]][s:s + least]))
            for j in big.tolist() for s in range(max(0, int(at[j]) - reach), int(at[j]) + 1)
            if s + least <= len(texts[ids[j], marks[j]])]
    if runs:
        i, m, s = (np.array(x, np.int64) for x in zip(*[r[:3] for r in runs]))
        a = np.array([r[3] >> 64 for r in runs], np.uint64)
        b = np.array([r[3] & (2**64 - 1) for r in runs], np.uint64)
        first, covered = _first_places(a, b, i, m, s)
        rows += _runs(i[covered], m[covered], s[covered], s[covered] + least, buckets, 2 * buckets)
        for bucket, p in _by_bucket((a[first] % np.uint64(buckets)).astype(np.int64)):
            p = first[p]
            rows.append(_pack(bucket + buckets, _RUNS, i[p], m[p], a[p], b[p], s[p].astype("<i4")))
    return _frame(rows)


def _run_hashes(data: np.ndarray, least: int) -> np.ndarray:
    """Polynomial hashes of the runs of ``least`` bytes at all places of ``data``, put together from powers of two."""
    def shift(n: int) -> np.uint64:
        return np.uint64(pow(int(_C[0]), n, 2**64))

    power, width = data.astype(np.uint64) * _C[1] + _C[2], 1
    found, done = np.zeros(len(data), np.uint64), 0
    while done < least:
        if least & width:
            count = len(data) - done - width + 1
            found = found[:count] * shift(width) + power[done:done + count]
            done += width
        power, width = power[:-width] * shift(width) + power[width:], 2 * width
    return found ^ (found >> np.uint64(32))


def diverse_places(texts: list[bytes], least: int) -> np.ndarray:
    """Places in the joined texts of the runs of ``least`` bytes that repeat with different bytes before them.

    A longer repeat has its places among those of its first ``least`` bytes. If these all have one byte before them, it is not
    maximal, so no suffix that starts at them is needed. Runs are told apart by 64-bit hashes: a clash can only keep more.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.maximum(lengths - least + 1, 0)
    places = np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    if not len(places):
        return places
    before = data[places - 1].astype(np.int16)
    before[np.repeat(begins, counts) == places] = -1
    hashes = _run_hashes(data, least)[places]
    order = np.argsort(hashes)
    new = _starts(hashes[order])
    lead = np.flatnonzero(new)
    low, high = (pick.reduceat(before[order], lead) for pick in (np.minimum, np.maximum))
    kept = (np.diff(np.r_[lead, len(order)]) > 1) & ((low != high) | (low < 0))
    return np.sort(places[order[kept[np.cumsum(new) - 1]]])


class SuffixArray:
    """Suffixes of short texts that are ``least`` bytes or longer, in order, with the common prefixes of neighbours.

    With ``starts``, only the suffixes at these places of the joined texts.
    """

    def __init__(self, texts: list[bytes], least: int, starts: np.ndarray | None = None):
        data = b"".join(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        self.owner = np.repeat(np.arange(len(texts)), lengths)
        self.begin = (ends - lengths)[self.owner]
        stop = ends[self.owner]
        places = np.flatnonzero(stop - np.arange(len(data)) >= least) if starts is None else starts
        suffixes = [data[a:b] for a, b in zip(places.tolist(), stop[places].tolist())]
        self.places = places[np.array(sorted(range(len(places)), key=suffixes.__getitem__), np.int64)]
        self.common = self._common(data, stop)
        seen = np.frombuffer(b"\0" + data, np.uint8).astype(np.int64)
        self.before = np.where(self.places > self.begin[self.places], seen[self.places], -1)

    def _common(self, data: bytes, stop: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each suffix and the one before it, compared eight bytes at a time."""
        words = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
        a, b = self.places[:-1], self.places[1:]
        most = np.minimum(stop[a] - a, stop[b] - b)
        found, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
        while len(open_):
            differ = words[a[open_] + found[open_]] ^ words[b[open_] + found[open_]]
            # The lowest bit that differs tells the first byte that differs; none differs: eight bytes are equal.
            found[open_] += np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
            open_ = open_[(differ == 0) & (found[open_] < most[open_])]
        return np.r_[np.zeros(min(1, len(self.places)), np.int64), np.minimum(found, most)]


def maximal_repeats(array: SuffixArray, least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, end): the suffixes ``first`` to ``end`` of the array start with a maximal repeat of that length.

    One scan of the common prefixes with a stack of open intervals. An interval is closed when a shorter common prefix comes;
    it is maximal if two of the bytes before its places differ, or one of them is the start of a text.
    """
    common, before = array.common.tolist() + [0], array.before.tolist()
    stack: list[list[int]] = []  # length, first suffix, byte before all its places so far (-1: they differ)

    def joined(x: int, y: int) -> int:
        return x if x == y else -1

    for at in range(1, len(common)):
        length = common[at] if common[at] >= least else 0
        first, byte = at - 1, before[at - 1]
        while stack and stack[-1][0] > length:
            size, begin, mine = stack.pop()
            mine = joined(mine, byte) if begin <= at - 1 else mine
            if mine < 0:
                yield size, begin, at
            first, byte = begin, mine
        if stack and stack[-1][0] == length:
            stack[-1][2] = joined(stack[-1][2], byte)
        elif length:
            stack.append([length, first, byte])


def _covered_in_contexts(texts: list[bytes], ids, begins, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, and starts and ends in their documents, of what an earlier place of a maximal repeat covers."""
    array = SuffixArray(texts, least, diverse_places(texts, least))
    owner = array.owner[array.places]
    start = array.places - array.begin[array.places] + begins[owner]
    order = np.lexsort((start, ids[owner]))
    turn = np.empty(len(order), np.int64)  # equal places have equal turns
    turn[order] = np.cumsum(_starts(ids[owner][order], start[order]))
    reach = np.zeros(len(turn), np.int64)  # length of the longest repeat in which a suffix is not the first
    lengths, first, end = np.array(list(maximal_repeats(array, least)), np.int64).reshape(-1, 3).T
    places = np.cumsum(end - first)
    for part in np.split(np.arange(len(places)), np.flatnonzero(np.diff(places // _PIECE)) + 1) if len(places) else ():
        sizes = (end - first)[part]
        leads = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(first[part] - leads, sizes)
        later = turn[at] > np.repeat(np.minimum.reduceat(turn[at], leads), sizes)
        np.maximum.at(reach, at[later], np.repeat(lengths[part], sizes)[later])
    found = np.flatnonzero(reach)
    return owner[found], start[found], start[found] + reach[found]


def _repeats(frame: pd.DataFrame, buckets: int, least: int) -> pd.DataFrame:
    """Covered places of the contexts, or of the runs, of one bucket."""
    rows = [(r.bucket - 2 * buckets, *r[1:]) for r in frame[frame["kind"] == _SPANS].itertuples(index=False)]
    runs = frame[frame["kind"] == _RUNS]
    if len(runs):
        ids, marks, a, b, at = _unpack(runs, "<u8", "<u8", "<i4")
        _, covered = _first_places(a, b, ids, marks, at)
        rows += _runs(ids[covered], marks[covered], at[covered], at[covered] + least, buckets)
    found = frame[frame["kind"] == _CONTEXTS]
    if len(found):
        ids, marks, h, shape = _unpack(found, "<u8", "<i4")
        begins, sizes = shape.reshape(-1, 2).T.astype(np.int64)
        cuts = np.r_[0, np.cumsum(sizes)]
        text = b"".join(map(bytes, found["text"]))
        order = np.argsort(h, kind="stable")
        new = np.flatnonzero(_starts(h[order]))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        batch: list[np.ndarray] = []
        held = 0

        def scan() -> None:
            places = np.concatenate(batch)
            texts = [text[cuts[j]:cuts[j + 1]] for j in places.tolist()]
            owner, starts, ends = _covered_in_contexts(texts, ids[places], begins[places], least)
            out.append((places[owner], starts, ends))

        for part in np.split(order, new[1:]):
            batch.append(part)
            held += int(sizes[part].sum())
            if held > _ARRAY:
                scan()
                batch, held = [], 0
        if batch:
            scan()
        j, s, e = (np.concatenate(x) for x in zip(*out))
        if len(j):
            rows += _merged(ids[j], marks[j], s, e, buckets)
    return _frame(rows)


def _merged(ids, marks, starts, ends, buckets: int) -> list[tuple]:
    """Packed spans of any lengths: of those with one start the longest, of those inside another none."""
    order = np.lexsort((-ends, starts, marks, ids))
    ids, marks, starts, ends = ids[order], marks[order], starts[order], ends[order]
    group = np.cumsum(_starts(ids, marks))
    reach = np.maximum.accumulate(ends + group * 2**40) - group * 2**40
    return _runs(ids, marks, starts, reach, buckets)


def _cut(docs: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    """Documents of one bucket with their spans cut out."""
    ids, marks, starts, ends = _unpack(spans, "<i4", "<i4")
    order = np.lexsort((starts, marks, ids))
    ids, marks, starts, ends = ids[order], marks[order], starts[order], ends[order]
    lead = np.flatnonzero(_starts(ids, marks))
    where = {(int(ids[a]), int(marks[a])): (a, b) for a, b in zip(lead.tolist(), np.r_[lead[1:], len(ids)].tolist())}
    rows = []
    for key, null, mark, text in zip(docs["id"], docs["no_id"], docs["mark"], docs["text"]):
        body = text.encode("utf-8", "surrogatepass")
        a, b = where.get((key, mark), (0, 0))
        kept, at, n_spans, open_end = [], 0, 0, -1
        for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist()):
            e = min(e, len(body))
            if s > open_end:
                kept.append(body[at:s])
                n_spans += 1
            open_end = max(open_end, e)
            at = max(at, e)
        kept.append(body[at:])
        left = b"".join(kept)
        rows.append((None if null else key, len(body), len(body) - len(left), n_spans, hashlib.sha256(left).hexdigest(), left))
    frame = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return frame.astype({"doc_id": "Int64"})


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, group: int = GROUP,
                   bucket_bytes: int = BUCKET_BYTES, kept: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if ``kept``."""
    if least < GRAM + 1:
        raise ValueError(f"runs have more than {GRAM} bytes")
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text_or_empty(text)))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // bucket_bytes))
    rows = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_NULL_ID)).alias("id"), F.col(key).isNull().alias("no_id"),
                       F.hash(text_or_empty(text)).alias("mark"), text_or_empty(text).alias("text"))

    found = rows.select("id", "mark", "text").mapInPandas(lambda f: _find(f, buckets, least), _PACKED)
    classes = materialize(
        found.groupBy("bucket").applyInPandas(lambda f: _classify(f, buckets, least, group), _PACKED), "anchor-classes")

    placed = rows.withColumn("bucket", _home_column("id", "mark", buckets))
    at_home = placed.groupBy("bucket")
    contexts = at_home.cogroup(classes.where(F.col("kind") == _ASKED).groupBy("bucket")).applyInPandas(
        lambda d, asked: _contexts(d, asked, buckets, least), _PACKED)
    repeats = contexts.groupBy("bucket").applyInPandas(lambda f: _repeats(f, buckets, least), _PACKED)
    spans = classes.where(F.col("kind") == _SPANS).unionByName(repeats)
    columns = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * kept

    def cut(d: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        out = _cut(d, s)
        return out if kept else out.drop(columns="kept")

    return at_home.cogroup(spans.groupBy("bucket")).applyInPandas(cut, columns)
