import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from riskspark.llm import sentencepiece as op


def odd_texts():
    rng = random.Random(11)
    texts = ["", " ", "   ", "Hello  world", " a\tb\nc\r\n", "ﬁ Å", "x\x00y", "é", "a" * 3000, "=-" * 300, "1234567890" * 40,
             "def f(x):\n    return x  # " * 20]
    texts += ["".join(rng.choice("aaab  \n.,!é漢字ü😀<>s/0x12") for _ in range(rng.randint(1, 200))) for _ in range(400)]
    for _ in range(100):
        ranges = [(32, 0x2000), (0x3000, 0xD000), (0x1F000, 0x1FFFF)]
        texts.append("".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(100)))
    return texts


def encoded(pieces, texts):
    made = op.Encoder(pieces, kept=500)
    return [x.tolist() for i in range(0, len(texts), 50) for x in made.encode(texts[i:i + 50])]


def test_same_ids_and_texts_as_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=op.MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.collect()] + odd_texts() + ["▁x y▁"]
    pieces = op.Pieces.load(op.MODEL)
    got = encoded(pieces, texts)
    assert got == library.encode(texts)
    assert [pieces.decode(g) for g in got] == library.decode(got)
    assert [t for t, g in zip(texts, got) if pieces.decode(g) != t] == ["▁x y▁"]


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_models_by_viterbi(fallback):
    model = proto.ModelProto()
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    model.trainer_spec.byte_fallback = fallback
    model.normalizer_spec.remove_extra_whitespaces = False
    rng = random.Random(2)
    model.pieces.add(piece="<unk>", score=0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    for b in range(256 * fallback):
        model.pieces.add(piece=f"<0x{b:02X}>", score=0, type=proto.ModelProto.SentencePiece.BYTE)
    names = {"▁", "a", "b", "c"} | {"".join(rng.choice("▁abc") for _ in range(rng.randint(2, 5))) for _ in range(60)}
    for n in sorted(names):
        model.pieces.add(piece=n, score=-rng.uniform(1, 20))
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = ["".join(rng.choice("aabbcc  d") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    assert encoded(op.Pieces.of(model), texts) == library.encode(texts)


def test_query_columns_nulls_and_clashing_names(spark, docs_of):
    docs = docs_of([None, "", "a  b", "a  b", "x" * 100_000]).withColumns({c: F.lit(1) for c in ("ids", "e", "n_tokens")})
    got = op.encode(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
    found = {r.doc_id: r for r in got.collect()}
    assert [found[i].n_tokens for i in (1, 2)] == [0, 0] and all(r.round_trip for r in found.values())
    assert found[3].ids == found[4].ids
    back = got.select("doc_id", op.decoded(got).alias("text")).collect()
    assert {r.doc_id: r.text for r in back} == {1: "", 2: "", 3: "a  b", 4: "a  b", 5: "x" * 100_000}
    assert op.encode(docs_of([])).count() == 0


def test_models_with_normalisation_are_refused():
    model = proto.ModelProto()
    model.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="normalisation"):
        op.Pieces.of(model)
