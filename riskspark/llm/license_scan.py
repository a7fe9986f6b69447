"""License scans by template-markup matching.

A template is license wording with markup: ``<<beginOptional>> ... <<endOptional>>`` may be left out, ``<<var;words=a-b>>``
stands for any ``a`` to ``b`` words, and everything else is mandatory and must match word by word. Each template is compiled
to an automaton over words, which is started at every word that can begin it and accepts the longest run it can.

Words are runs of digits, letters and characters beyond ASCII after lower-casing A-Z. The base phrases are templates
without markup. Templates are a fixed list, so the automata are of fixed size.

Defined cases: null and empty texts have no words, no places and score 0. Overlapping places all count for ``n_base``;
``score`` is the share of a text's words that stand in any place of any template. Repeated rows each get their row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_batches, text_or_empty
from .decontaminate import words_of

# The base phrases and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Wording of public license notices, with markup for what may vary.
TEMPLATES = (
    ("<<beginOptional>>released<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> MIT "
     "<<beginOptional>>open source<<endOptional>> license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction", "mit"),
    ("licensed under the Apache <<beginOptional>>software<<endOptional>> license <<beginOptional>>version<<endOptional>> 2 "
     "<<beginOptional>>0<<endOptional>>", "apache-2"),
    ("<<beginOptional>>licensed<<endOptional>> under <<beginOptional>>the terms of<<endOptional>> the GNU general public "
     "license <<beginOptional>>as published by the free software foundation<<endOptional>> <<beginOptional>>either"
     "<<endOptional>> version 3", "gpl-3"),
    ("<<beginOptional>>licensed<<endOptional>> under <<beginOptional>>the terms of<<endOptional>> the GNU general public "
     "license <<beginOptional>>as published by the free software foundation<<endOptional>> <<beginOptional>>either"
     "<<endOptional>> version 2", "gpl-2"),
    ("under <<beginOptional>>the terms of<<endOptional>> the GNU lesser general public license <<beginOptional>>as "
     "published by the free software foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version "
     "<<var;words=1-2>>", "lgpl"),
    ("subject to the terms of the Mozilla public license <<beginOptional>>v<<endOptional>> <<beginOptional>>version"
     "<<endOptional>> 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met <<var;words=0-120>> neither the name of <<var;words=1-12>> nor the names of its "
     "contributors may be used", "bsd-3-clause"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> creative commons attribution "
     "<<beginOptional>><<var;words=0-1>> international<<endOptional>> license", "cc-by"),
    ("licensed under CC BY NC <<beginOptional>><<var;words=1-1>> 0<<endOptional>>", "cc-by-nc"),
    ("licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> creative commons attribution "
     "noncommercial <<var;words=0-3>> license", "cc-by-nc"),
    ("licensed under CC BY SA <<beginOptional>><<var;words=1-1>> 0<<endOptional>>", "cc-by-sa"),
    ("to the extent possible under law <<var;words=1-12>> has waived all copyright and related or neighboring rights",
     "cc0"),
)

_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")


@dataclass
class Automaton:
    """States are numbers; ``words`` and ``anything`` consume a word, ``free`` does not. ``end`` accepts."""

    label: str
    base: bool
    words: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    anything: list[int] = field(default_factory=lambda: [-1])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    end: int = 0

    def state(self) -> int:
        self.words.append({})
        self.anything.append(-1)
        self.free.append([])
        return len(self.words) - 1

    def closed(self, states) -> set[int]:
        seen, open_ = set(states), list(states)
        while open_:
            for s in self.free[open_.pop()]:
                if s not in seen:
                    seen.add(s)
                    open_.append(s)
        return seen

    def longest(self, text: list[bytes], start: int) -> int:
        """End of the longest accepted run from ``start``, or -1."""
        states, at, best = self.closed([0]), start, -1
        while states:
            if self.end in states and at > start:
                best = at
            if at == len(text):
                break
            word = text[at]
            states = self.closed({t for s in states for t in (self.words[s].get(word, -1), self.anything[s]) if t >= 0})
            at += 1
        return best


def compile_template(markup: str, label: str, base: bool = False) -> Automaton:
    made = Automaton(label, base)
    at, opened, place = 0, [], 0

    def read(piece: str) -> None:
        nonlocal at
        for word in words_of(piece):
            new = made.state()
            made.words[at][word] = new
            at = new

    for mark in _MARK.finditer(markup):
        read(markup[place:mark.start()])
        place = mark.end()
        if mark[1] == "beginOptional":
            new = made.state()  # so that leaving it out cannot mix with words before
            made.free[at].append(new)
            at = new
            opened.append(at)
        elif mark[1] == "endOptional":
            new = made.state()
            made.free[at].append(new)
            made.free[opened.pop()].append(new)
            at = new
        else:
            low, high = int(mark[2]), int(mark[3])
            steps = [at]
            for _ in range(high):
                new = made.state()
                made.anything[steps[-1]] = new
                steps.append(new)
            out = made.state()
            for s in steps[low:]:
                made.free[s].append(out)
            at = out
    read(markup[place:])
    made.end = at
    return made


def compiled(base=BASE, templates=TEMPLATES) -> dict[bytes, list[Automaton]]:
    """Automata by the words that can begin them."""
    first: dict[bytes, list[Automaton]] = {}
    automata = [compile_template(m, label, True) for m, label in base]
    automata += [compile_template(m, label) for m, label in templates]
    for a in automata:
        begin = {w for s in a.closed([0]) for w in a.words[s]}
        if a.end in a.closed([0]) or any(a.anything[s] >= 0 for s in a.closed([0])):
            raise ValueError(f"a template must begin with a mandatory word: {a.label}")
        for word in begin:
            first.setdefault(word, []).append(a)
    return first


def places(text: list[bytes], first: dict[bytes, list[Automaton]]) -> list[tuple[int, int, str, bool]]:
    """(start, end, label, base) of every place where a template matches."""
    found = []
    if first.keys().isdisjoint(text):
        return found
    for start, word in enumerate(text):
        for a in first.get(word, ()):
            if (end := a.longest(text, start)) > 0:
                found.append((start, end, a.label, a.base))
    return found


def _summary(text: list[bytes], first) -> tuple:
    found = places(text, first)
    starts = [s for s, _, _, base in found if base]
    covered = {i for s, e, _, _ in found for i in range(s, e)}
    return (
        len(text), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, _, label, base in found if base})), ",".join(sorted({f[2] for f in found})),
        len(covered) / len(text) if text else 0.0)


def scan(docs: DataFrame, key: str = "doc_id", text: str | Column = "text", base=BASE, templates=TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    small_batches(docs.sparkSession)
    first = compiled(base, templates)
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    @F.pandas_udf("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
                  "score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame([_summary(words_of(t), first) for t in texts], columns=columns)
        return rows.astype({"first_word": "Int64", "last_word": "Int64"})

    answer = of.asNondeterministic()(text_or_empty(text))
    return docs.select(F.col(key).alias("doc_id"), answer.alias("a")).select("doc_id", "a.*")
