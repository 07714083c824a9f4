"""Operator 13 against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lakeshift.llm import piece_bpe


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.codec(piece_bpe.default_model())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.default_model())


ODD = [
    *["", " ", "  a  b ", "▁x", "▁▁ x ▁", "\n", "a\n b", "  \n  ", "\x00x", "é ﬁ Ａ", "😀 x", "<s> <0x0A> <unk>", "　全角　スペース"],
    *["a" * 3000, "▁" * 77, " " * 133 + "x", "\r\n\t x", "梦" * 500 + "ab", "word " * 70_000],
]


def test_encoding_and_decoding_equal_the_library(pieces, library):
    rng = random.Random(3)
    vocabulary = [library.id_to_piece(k).replace("▁", " ") for k in range(259, library.vocab_size())]
    alphabet = "aeinrst ▁\n.,é梦벨ゼ😀́ﬁxTH0123_- "
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    for text in texts:
        want, got = library.encode(text), pieces.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want, text[:80]
        assert pieces.decode(got) == library.decode(want), text[:80]
        assert pieces.decimals(got).decode() == ",".join(map(str, want))


def test_any_ids_decode_as_in_the_library(pieces, library):
    rng = random.Random(4)
    for _ in range(4000):  # bytes, control and unknown ids in any order
        ids = [rng.randrange(library.vocab_size()) if rng.random() < 0.4 else rng.randrange(270) for _ in range(rng.randrange(12))]
        assert pieces.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_a_walk_that_fails_takes_pieces_back(pieces):
    """Some longest first piece is wrong: else the field of failed positions would never be used."""
    failures = 0
    for text in ("".join(p) for p in zip(*[iter([pieces.text_of[k] for k in range(300, 6300)])] * 3, strict=True)):
        text = text.replace("▁", "")
        failed = bytearray((len(text) >> 3) + 1)
        ids = pieces._walk(text, pieces._longest(text), 0, len(text), failed)
        assert [pieces.text_of[k] for k in ids] == pieces._merged(list(text))[0]
        failures += any(failed)
    assert failures


def test_query_on_the_whole_table(spark, library):
    from __spark_entry__ import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in docs:
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = queries()["op13_piece_roundtrip"](spark, "/root/testdata/sf0.001").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(docs)


def test_edge_cases(spark):
    model = piece_bpe.default_model()
    rows = [(1, None, "x"), (None, "a b", "y"), (2, "", "z"), (2, "a b", None), (2, "a b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in piece_bpe.digests(docs, model).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (1, 0, empty, empty) in out and (2, 0, empty, empty) in out and len(out) == 4
    back = piece_bpe.decode(piece_bpe.encode(docs, model), model)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == [(0, "a b"), (1, ""), (2, ""), (2, "a b"), (2, "a b")]
    assert piece_bpe.digests(docs.where(F.lit(False)), model).collect() == []
    assert piece_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), model).collect() == [(1, "")]


def test_other_models_are_refused(tmp_path):
    unigram = bytes([0x12, 0x02, 0x18, 0x01])  # a trainer's field 3: kind 1
    (tmp_path / "m").write_bytes(unigram)
    with pytest.raises(ValueError):
        piece_bpe.Model(str(tmp_path / "m"))
