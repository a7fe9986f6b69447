"""SentencePiece encoding and decoding by a forward pass over a trie of words.

A text is marked as the model says (a blank becomes ``▁``, one is put in front) and cut where no piece can reach across:
before each run of marks, and around characters that no longer piece contains. The distinct words of a batch are sorted,
which lists the nodes of their trie depth-first, and each word takes up the forward states of the prefix it shares with the
word before it.

* For a unigram model the state of a prefix is its best score and last piece (Viterbi).
* A BPE model has no additive score. Its state is the last piece of the prefix's encoding. A row of pieces is what the
  merges give just when each neighbouring pair is what the merges give for that pair alone: up to the first merge across a
  boundary the pieces on its two sides are built as they would be without the rest, so that merge would also happen in the
  pair. So a prefix's last piece is the one that fits the last piece of the prefix before it, and exactly one does.

The model file is read on the driver; its pieces (a vocabulary of fixed size) are broadcast as plain data. A worker process
builds its encoder once and keeps encoded words, up to a bound, for all tasks that it runs. A text comes back if all its words
do, so that is found out per distinct word.

Defined cases: null and empty texts have no ids. Characters outside the vocabulary become byte pieces if the model has them,
else the unknown piece. Decoding turns every mark into a blank, so a text that holds the mark character itself does not come
back; every other text does if the model has byte pieces. Repeated rows each get their row.
"""

from __future__ import annotations

import re
from itertools import chain, filterfalse

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_batches, text_or_empty

MARK = "▁"
#: Path of the model used by the registered query.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Encoded words a worker process keeps for later batches and tasks.
KEPT_WORDS = 1_000_000
#: Pairs of pieces it remembers to fit or not.
KEPT_PAIRS = 500_000


class Pieces:
    """The vocabulary of a model and its encoder."""

    def __init__(self, pieces: dict[str, tuple[int, float]], text_of: list[bytes], byte_ids: list[int] | None, unknown: int,
                 prefix: bool, unigram: bool):
        #: Enough to make the same again; broadcast in place of this object, whose class executors may not have.
        self.plain = (pieces, text_of, byte_ids, unknown, prefix, unigram)
        self.pieces, self.text_of, self.byte_ids, self.unknown = pieces, text_of, byte_ids, unknown
        self.prefix, self.unigram = prefix, unigram
        self.longest = max(map(len, pieces), default=1)
        self.lowest = min((s for _, s in pieces.values()), default=0.0) - 10.0  # score of an unknown character
        self.known = {p: (i,) for p, (i, _) in pieces.items()}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        #: Ends of pieces, and whether they are pieces themselves.
        self.tails = {p[i:]: False for p in pieces for i in range(len(p))} | dict.fromkeys(pieces, True)
        inner = set("".join(p for p in pieces if len(p) > 1))
        lone = "".join(re.escape(c) for c in "\n\r\t" if c not in inner)
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        rest = f"[^{MARK}{lone}]"
        self.word = None if crossing else re.compile(f"{MARK}+{rest}*|{rest}+" + (f"|[{lone}]" if lone else ""))

    @staticmethod
    def load(path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        return Pieces.of(model)

    @staticmethod
    def of(model) -> Pieces:
        kinds = model.SentencePiece
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        if model.trainer_spec.treat_whitespace_as_suffix or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("marks as suffixes, user-defined and unused pieces are not supported")
        pieces, text_of, byte_ids, unknown = {}, [], {}, 0
        for i, p in enumerate(model.pieces):
            text = b""
            if p.type == kinds.NORMAL:
                pieces[p.piece] = (i, p.score)
                text = p.piece.replace(MARK, " ").encode()
            elif p.type == kinds.BYTE:
                byte = int(p.piece[3:5], 16)
                byte_ids[byte], text = i, bytes([byte])
            elif p.type == kinds.UNKNOWN:
                unknown, text = i, model.trainer_spec.unk_surface.encode()
            text_of.append(text)
        fallback = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        unigram = model.trainer_spec.model_type == model.trainer_spec.UNIGRAM
        if not unigram and model.trainer_spec.model_type != model.trainer_spec.BPE:
            raise ValueError("only unigram and BPE models are supported")
        return Pieces(pieces, text_of, fallback, unknown, spec.add_dummy_prefix, unigram)

    # ------------------------------------------------------------ words

    def words(self, text: str) -> list[str]:
        marked = text.replace(" ", MARK)
        if self.prefix and text:
            marked = MARK + marked
        return ([marked] if marked else []) if self.word is None else self.word.findall(marked)

    def _merged(self, text: str) -> list[str]:
        """The merges themselves; used for pairs of pieces only, which are short."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.pieces.get(parts[i] + parts[i + 1])
                if found and (best is None or found[1] > best):
                    best, at = found[1], i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, before: str, piece: str) -> bool:
        return self._merged(before + piece) == ([before, piece] if before else [piece])

    def encode_words(self, words) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words, by one walk over their trie."""
        out, last_word = {}, ""
        # By depth: the prefix's last piece, its ids and where it begins, and the prefix's score if the model has one.
        lasts, ids, begins, scores = [""], [()], [0], [0.0]
        step = self._best if self.unigram else self._fitting
        for word in sorted(words):
            depth, most = 0, min(len(word), len(last_word))
            while depth < most and word[depth] == last_word[depth]:
                depth += 1
            del lasts[depth + 1:], ids[depth + 1:], begins[depth + 1:], scores[depth + 1:]
            step(word, depth, lasts, ids, begins, scores)
            last_word, end, parts = word, len(word), []
            while end:
                parts.append(ids[end])
                end = begins[end]
            parts.reverse()
            out[word] = tuple(chain.from_iterable(parts))
        if self.byte_ids is None:  # a run of unknown characters is one unknown piece
            none = self.unknown
            out = {w: tuple(x for i, x in enumerate(t) if x != none or not i or t[i - 1] != x) for w, t in out.items()}
        return out

    def _best(self, word: str, depth: int, lasts: list[str], ids: list[tuple[int, ...]], begins: list[int], scores: list[float]) -> None:
        """Adds the best-scored states of the prefixes longer than ``depth``."""
        for end in range(depth + 1, len(word) + 1):
            top, last, at = None, "", 0
            for start in range(max(0, end - self.longest), end):
                piece = word[start:end]
                found = self.pieces.get(piece)
                if found is None and start < end - 1:
                    continue
                # Rounded as single precision, so that ties fall as in the models' own library.
                score = float(np.float32(scores[start] + (self.lowest if found is None else found[1])))
                if top is None or score > top:
                    top, last, at = score, piece, start
            lasts.append(last)
            ids.append(self._ids(last))
            begins.append(at)
            scores.append(top)

    def _fitting(self, word: str, depth: int, lasts: list[str], ids: list[tuple[int, ...]], begins: list[int], scores: list[float]) -> None:
        """Adds the only possible states of the prefixes longer than ``depth``; shorter pieces are tried first."""
        pairs, tails, known = self.pairs, self.tails, self.known
        if self.n_pairs > KEPT_PAIRS:
            pairs.clear()
            self.n_pairs = 0
        for end in range(depth + 1, len(word) + 1):
            start = end - 1
            piece = word[start]
            whole = True
            while True:
                if whole:
                    last = lasts[start]
                    of = pairs.get(last)
                    if of is None:
                        of = pairs[last] = {}
                    fits = of.get(piece)
                    if fits is None:
                        fits = of[piece] = self._fits(last, piece)
                        self.n_pairs += 1
                    if fits:
                        break
                start -= 1
                if start < 0:
                    raise AssertionError("some piece fits every prefix")
                piece = word[start:end]
                whole = tails.get(piece)
                if whole is None:
                    raise AssertionError("some piece fits every prefix")
            lasts.append(piece)
            ids.append(known.get(piece) or self._ids(piece))
            begins.append(start)

    def _ids(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece; several if it is a character that becomes bytes."""
        found = self.pieces.get(piece)
        if found is not None:
            return (found[0],)
        if self.byte_ids is not None:
            return tuple(self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
        return (self.unknown,)

    def decode(self, ids) -> str:
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class Encoder:
    """Encodes batches, keeping the words of earlier ones up to a bound."""

    def __init__(self, pieces: Pieces, kept: int = KEPT_WORDS):
        self.pieces, self.kept = pieces, kept
        self._forget()

    def _forget(self) -> None:
        """Words by number; their ids end to end, where each word's begin, how many there are, and whether they come back."""
        self.number: dict[str, int] = {}
        self.flat, self.start = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.size, self.back = np.zeros(0, np.int64), np.zeros(0, bool)

    def _learn(self, words: set[str]) -> None:
        found = self.pieces.encode_words(words)
        known = len(self.number)
        self.number.update(zip(found, range(known, known + len(found))))
        size = np.fromiter(map(len, found.values()), np.int64, len(found))
        text_of = self.pieces.text_of.__getitem__
        back = [b"".join(map(text_of, ids)) == w.replace(MARK, " ").encode("utf-8", "surrogatepass") for w, ids in found.items()]
        self.start = np.r_[self.start, len(self.flat) + np.cumsum(size) - size]
        self.flat = np.r_[self.flat, np.fromiter(chain.from_iterable(found.values()), np.int32, int(size.sum()))]
        self.size, self.back = np.r_[self.size, size], np.r_[self.back, np.array(back, bool)]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """Ids of all texts end to end, where each text's end, and whether decoding gives it back."""
        words = [self.pieces.words(t) for t in texts]
        flat = list(chain.from_iterable(words))
        new = set(filterfalse(self.number.__contains__, flat))
        if len(self.number) + len(new) > self.kept:
            self._forget()
            new = set(flat)
        if new:
            self._learn(new)
        at = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        last = np.cumsum([0, *map(len, words)])
        bad = np.r_[0, np.cumsum(~self.back[at])][last]
        same = [not n and MARK not in t for n, t in zip((bad[1:] - bad[:-1]).tolist(), texts)]
        return ids, np.r_[0, ends][last[1:]], same

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, ends, _ = self.encode_all(texts)
        return np.split(ids, ends[:-1]) if texts else []


def _encoder(shared: Broadcast) -> Encoder:
    """The encoder of a worker process: the broadcast dict is one object there, whatever task asks."""
    held = shared.value
    if "encoder" not in held:
        held["encoder"] = Encoder(Pieces(*held["plain"]))
    return held["encoder"]


def _shared(docs: DataFrame, model: str) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast({"plain": Pieces.load(model).plain})


def encoding(docs: DataFrame, text: str | Column = "text", model: str = MODEL) -> Column:
    """Struct (ids, round_trip): the ids of a text, and whether decoding them gives it back."""
    small_batches(docs.sparkSession)
    shared = _shared(docs, model)

    @F.arrow_udf("struct<ids: array<int>, round_trip: boolean>")
    def of(texts):
        import pyarrow as pa

        encoder, texts = _encoder(shared), texts.to_pylist()
        ids, ends, same = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], []
        for at in range(0, len(texts), 200):
            found, last, back = encoder.encode_all(texts[at:at + 200])
            ids.append(found)
            ends.append(ends[-1][-1] + last)
            same += back
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
        return pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], ["ids", "round_trip"])

    return of.asNondeterministic()(text_or_empty(text))


def decoded(docs: DataFrame, ids: str | Column = "ids", model: str = MODEL) -> Column:
    """Texts of arrays of ids; null for a null array, which has no text."""
    shared = _shared(docs, model)

    @F.arrow_udf("string")
    def of(arrays):
        import pyarrow as pa

        decode = _encoder(shared).pieces.decode
        return pa.array([None if a is None else decode(a) for a in arrays.to_pylist()], pa.string())

    return of.asNondeterministic()(F.col(ids) if isinstance(ids, str) else ids)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, round_trip."""
    answered = docs.select(F.col(key).alias("doc_id"), encoding(docs, text, model).alias("e"))
    return answered.select("doc_id", F.size("e.ids").cast("bigint").alias("n_tokens"), "e.ids", "e.round_trip")
