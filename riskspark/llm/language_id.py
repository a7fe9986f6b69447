"""Language identification with language-bitmask n-gram filters.

An n-gram is a letter with its two neighbours, lower-cased, where everything but a letter reads as a blank. A language's
n-grams are those that make up at least ``min_share`` of its n-grams in the training texts and at least ``min_ratio`` of the
share in the language that has it most, so a language has at most ``1 / min_share`` of them whatever the corpus.

They are put into one bit-sliced Bloom filter: a row of the filter is a bitmask over the languages, and the AND of an n-gram's
rows names all languages that contain it. A text's hits per language are corrected for the filter's false positives, and the
language with most of them is chosen.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text if nothing could be learned.
Null languages are not learned from. Ties go to the language that sorts first. Repeated rows each get their row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import crc_fold, kept_rows, small_batches, text_or_empty, with_answer

UNKNOWN = "und"
#: Rows of the filter and rows looked up for an n-gram.
SLOTS, PROBES = 1 << 18, 3
MIN_SHARE, MIN_RATIO = 5e-5, 0.1
#: Texts of which fewer n-grams belong to the chosen language are in none of the learned ones.
LEAST_SCORE = 0.2
#: Characters worked on at once in a task.
_PIECE = 1 << 20
_MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _grams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the texts one after the other, and how many each text has."""
    lowered = [t.lower() for t in texts]
    joined = (" " + "  ".join(lowered) + " ").encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(joined, np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in lowered])
    is_letter = letters[points]
    points = np.where(is_letter, points, np.uint64(32))
    middle = np.flatnonzero(is_letter)
    grams = points[middle - 1] << np.uint64(42) | points[middle] << np.uint64(21) | points[middle + 1]
    ends = np.cumsum(lengths + 2)
    counts = np.diff(np.searchsorted(middle, np.r_[0, ends]))
    return grams, counts


def _pieces(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in groups of about a piece; a longer text is a group of its own."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > _PIECE:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """n-gram counts by language of one partition, added up before they are shuffled."""
    letters, total = _letters(), None
    for frame in frames:
        for lang, texts in frame.groupby("lang", sort=False)["text"]:
            for group in _pieces(texts):
                grams, n = np.unique(_grams(group, letters)[0], return_counts=True)
                part = pd.DataFrame({"lang": lang, "gram": grams.view(np.int64), "n": n})
                total = part if total is None else pd.concat([total, part])
            if total is not None and len(total) > 500_000:
                total = total.groupby(["lang", "gram"], as_index=False)["n"].sum()
                if len(total) > 400_000:
                    yield total
                    total = None
    if total is not None:
        yield total.groupby(["lang", "gram"], as_index=False)["n"].sum()


@dataclass
class GramFilter:
    """Rows of language bitmasks, the languages by bit, and the share of false positives by language."""

    rows: np.ndarray
    languages: list[str]
    false: np.ndarray

    @staticmethod
    def build(languages: list[str], grams: dict[str, np.ndarray], slots: int = SLOTS) -> GramFilter:
        rows = np.zeros((slots, max(1, -(-len(languages) // 8))), np.uint8)
        for bit, lang in enumerate(languages):
            for at in _slots(grams[lang], slots):
                rows[at, bit // 8] |= np.uint8(1 << bit % 8)
        bits = np.unpackbits(rows, axis=1, bitorder="little")[:, :len(languages)]
        return GramFilter(rows, languages, bits.mean(axis=0) ** PROBES)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """One bit per n-gram and language that contains it."""
        found = None
        for at in _slots(grams, len(self.rows)):
            found = self.rows[at] if found is None else found & self.rows[at]
        return found

    def predict(self, texts: list[str], letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        grams, counts = _grams(texts, letters)
        if not len(grams) or not self.languages:
            return best, score
        bits = np.unpackbits(self.masks(grams), axis=1, bitorder="little")[:, :len(self.languages)]
        some = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[some]
        hits = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        share = (hits / counts[some, None] - self.false) / np.maximum(1 - self.false, 1e-9)
        share = np.clip(share, 0, 1)
        for row, choice in zip(some.tolist(), share.argmax(axis=1).tolist()):
            best[row] = self.languages[choice]
        score[some] = share.max(axis=1)
        return best, score


def _slots(grams: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    for mixer in _MIXERS:
        mixed = (grams ^ grams >> np.uint64(29)) * np.uint64(mixer)
        yield ((mixed >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE,
          min_ratio: float = MIN_RATIO, slots: int = SLOTS) -> GramFilter:
    """The filter of all rows of ``docs`` that have a text and a language."""
    small_batches(docs.sparkSession)
    counts = materialize(
        docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
        .mapInPandas(_count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts"
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(F.broadcast(totals), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    frequent = share.where(F.col("share") >= min_share)
    most = frequent.groupBy("gram").agg(F.max("share").alias("most"))
    chosen = frequent.join(most, "gram").where(F.col("share") >= min_ratio * F.col("most")).select("lang", "gram").toPandas()
    languages = sorted(r["lang"] for r in totals.select("lang").collect())
    grams = {k: v.to_numpy().view(np.uint64) for k, v in chosen.groupby("lang")["gram"]}
    return GramFilter.build(languages, {k: grams.get(k, np.zeros(0, np.uint64)) for k in languages}, slots)


def prediction(docs: DataFrame, model: GramFilter, text: str = "text") -> Column:
    """Struct (lang_pred, score) for a text of ``docs``."""
    small_batches(docs.sparkSession)
    # Plain data, as executors need not have this class.
    shared = docs.sparkSession.sparkContext.broadcast((model.rows, model.languages, model.false))
    known: dict = {}

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        if not known:
            known.update(letters=_letters(), model=GramFilter(*shared.value))
        best, score = [], [np.zeros(0)]
        for group in _pieces(texts):
            b, s = known["model"].predict(group, known["letters"])
            best += b
            score.append(s)
        return pd.DataFrame({"lang_pred": best, "score": np.concatenate(score)})

    return of.asNondeterministic()(text_or_empty(text))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3,
             held_out: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learned from the rows outside fold ``held_out``."""
    out = crc_fold(key, folds) == held_out
    model = learn(docs.where(~out), text, lang)
    answered = docs.select(F.col(key).alias("doc_id"), out.alias("held_out"), prediction(docs, model, text).alias("p"))
    return answered.select("doc_id", "held_out", "p.*")


def known_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held_out: int = 1,
               least: float = LEAST_SCORE) -> DataFrame:
    """The rows in one of the learned languages with at least score ``least``, with the columns they came with."""
    model = learn(docs.where(crc_fold(key, folds) != held_out), text, lang)
    answered = with_answer(docs, prediction(docs, model, text))
    return kept_rows(answered, (F.col("__answer.lang_pred") != UNKNOWN) & (F.col("__answer.score") >= least))
