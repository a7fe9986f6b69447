import random
import re

from pyspark.sql import functions as F

from riskspark.llm import license_scan as op


def pattern(markup):
    """The template as a regular expression over words that each end with a blank."""
    out = ""
    for piece in re.split(r"(<<.*?>>)", markup):
        if piece == "<<beginOptional>>":
            out += "(?:"
        elif piece == "<<endOptional>>":
            out += ")?"
        elif piece.startswith("<<var"):
            low, high = re.findall(r"\d+", piece)
            out += f"(?:[^ ]+ ){{{low},{high}}}"
        else:
            out += "".join(w + " " for w in re.findall(r"[0-9a-z]+", piece.lower()))
    return re.compile(out)


def brute(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base, labels, covered = [], set(), set()
    for i in range(len(words)):
        rest = " ".join(words[i:i + 400]) + " "
        for markup, label in op.BASE + op.TEMPLATES:
            # The longest match: the expression's own choice may stop early, so every length is tried.
            ends = [n for n in range(1, min(len(words) - i, 200) + 1)
                    if pattern(markup).fullmatch(" ".join(words[i:i + n]) + " ")] if pattern(markup).match(rest) else []
            if ends:
                covered |= set(range(i, i + ends[-1]))
                labels.add(label)
                if (markup, label) in op.BASE:
                    base.append((i, label))
    return (len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
            ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)), len(covered) / len(words) if words else 0.0)


def test_against_regular_expressions(spark, docs_of):
    rng = random.Random(5)
    pool = sorted({w for m, _ in op.BASE + op.TEMPLATES for w in re.sub(r"<<.*?>>", " ", m).split()})
    texts = [None, "", "?!", "Released under the MIT License.", "under the mit license under the MIT license",
             "Licensed under the Apache License, Version 2.0.", "apache license version 2", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3.", "cc by nc", "cc by ncx", "2 mit",
             "under the terms of the MIT license", "under the terms of MIT license", "the MIT license under",
             "to the extent possible under law Some One has waived all copyright and related or neighboring rights",
             "licensed under a creative commons attribution 4.0 international license"]
    texts += [" ".join(rng.choice(pool) for _ in range(60)) for _ in range(20)]
    for m, _ in op.TEMPLATES:
        for keep in (0, 1):
            m2 = re.sub(r"<<var;words=(\d+)-(\d+)>>", lambda v: " ".join(["any"] * int(v[1 + keep])), m)
            m2 = re.sub(r"<<beginOptional>>(.*?)<<endOptional>>", r"\1" if keep else " ", m2)
            texts += [f"x {m2} y", m2.replace(" the ", " that ", 1)]
    texts.append("word " * 30_000 + "apache license version 2")
    got = {r.doc_id: tuple(r)[1:] for r in op.scan(docs_of(texts).withColumn("score", F.lit(1))).collect()}
    want = {i: brute(t) for i, t in enumerate(texts[:-1], 1)}
    assert got.pop(len(texts))[:4] == (30_004, 1, 30_000, 30_000)
    assert got == want


def test_empty_and_repeated(docs_of):
    assert op.scan(docs_of([])).count() == 0
    assert [r.labels for r in op.scan(docs_of([(1, "cc by nc"), (1, "cc by nc")])).collect()] == ["cc-by-nc"] * 2
