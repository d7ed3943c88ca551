"""SentencePiece encoding and decoding against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from meterflow.llm import pieces
from meterflow.llm.queries import PIECES, piece_digests


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def odd_texts() -> list[str]:
    rng = random.Random(11)
    letters = [*"ab'strevmldeeeiionnth   \n\t 12.,!é漢字½٣\x1c\x85😀​ ▁", "\0", "  ", "    ", "<s>", "<0x41>", "the "]
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(3000)]
    return texts + [" " * k for k in range(60)] + ["x" * 5000, "the" * 3000, " " * 999 + "x", "ä" * 3000, "日本語" * 1000, ""]


def test_ids_and_texts_equal_the_library(library):
    known = pieces.vocabulary(PIECES)
    for text in odd_texts():
        expected = library.encode(text, add_bos=True, add_eos=True)
        packed = known.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == expected, repr(text)
        assert known.decode(packed) == library.decode(expected), repr(text)


def test_backtracking_equals_merging():
    known, rng = pieces.vocabulary(PIECES), random.Random(12)
    for _ in range(3000):
        text = "".join(rng.choices("▁abcdeghinorst漢☃", k=rng.randrange(1, 30)))
        assert known.tokens(text) == known.merge(text), text
    for text in ("the" * 400, "abababab" * 100):
        assert known.tokens(text) == known.merge(text)


def test_any_ids_decode_like_the_library(library):
    known, rng = pieces.vocabulary(PIECES), random.Random(13)
    for _ in range(3000):
        ids = [rng.randrange(400 if rng.random() < 0.7 else 32_000) for _ in range(rng.randrange(9))]
        assert known.decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids), ids


def test_a_text_of_ten_megabytes(library):
    for text in ("word " * 2_000_000, "日本語の" * 400_000, "x" * 1_000_000):
        ids = pieces.vocabulary(PIECES).encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_other_models_are_refused(tmp_path):
    with open(PIECES, "rb") as file:
        data = file.read()
    changed = tmp_path / "other.model"
    changed.write_bytes(data.replace(b"\n\x08identity", b"\n\x08nmtother").replace(b"\x18\x02 \x80", b"\x18\x01 \x80"))
    with pytest.raises(ValueError):
        pieces.Vocabulary(str(changed))


def test_rows_of_any_kind(spark, library):
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "it's"), (5, "word " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS n_tokens", "3 AS decoded", "4 AS _key")
    got = sorted(piece_digests(docs).collect(), key=lambda r: r.doc_id or 0)
    assert [r.doc_id for r in got] == [None, 1, 1, 2, 3, 5]
    for row, text in zip(got, ["it's", "a b", "a b", "", "", rows[5][1]], strict=True):
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert piece_digests(docs.limit(0)).count() == 0
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs, PIECES), PIECES).collect()}
    assert back[1] == "a b" and back[2] == ""


def test_the_model_is_the_public_one():
    assert PIECES == public_tokenizers.path("piece_bpe_32k.model")
