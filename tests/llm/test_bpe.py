"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from meterflow.llm import bpe
from meterflow.llm.queries import RANKS, token_digests


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def odd_texts() -> list[str]:
    rng = random.Random(1)
    letters = list("ab'strevmld  \n\t 12.,!é漢  字½٣'\x1c\x85😀​ ")
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(3000)]
    return texts + [
        "", " ", "  ", "\n", "'", "'s", "a's", "a'", "'ll", " 'll", "é'll ", "x" * 5000, "ab'" * 300,
        "ä" * 3000, " " * 999, "don't they've I'd",
    ]


def test_ids_and_decoding_equal_the_library(library):
    texts = odd_texts()
    rows = bpe.encode_texts([t.encode() for t in texts], RANKS)
    for text, (ids, offsets) in zip(texts, rows, strict=True):
        expected = library.encode_ordinary(text)
        assert np.frombuffer(ids, "<u4").tolist() == expected, repr(text)
        assert bpe.merger(RANKS).decode(ids) == text.encode()
        assert len(offsets) // 4 <= len(expected)


def test_prefix_products_equal_a_plain_run():
    symbols = np.random.default_rng(3).integers(0, 9, 70_000)
    state, plain = bpe.FRESH, []
    for x in symbols.tolist():
        state, starts = bpe._step(state, x)
        plain.append(starts)
    assert bpe.scanner().boundaries(symbols).tolist() == plain


def test_rows_of_any_kind(spark, library):
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "it's"), (5, "word " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS ids", "2 AS n_tokens", "3 AS decoded"
    )
    got = sorted(token_digests(docs).collect(), key=lambda r: r.doc_id or 0)
    assert [r.doc_id for r in got] == [None, 1, 1, 2, 3, 5]
    for row, text in zip(got, ["it's", "a b", "a b", "", "", rows[5][1]], strict=True):
        ids = np.array(library.encode_ordinary(text), dtype="<u4").tobytes()
        assert row.n_tokens == len(ids) // 4
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert token_digests(docs.limit(0)).count() == 0
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()}
    assert bytes(back[1]) == b"a b" and bytes(back[2]) == b""


def test_spans_are_decoded_by_offsets(spark, library):
    text = "It's a naïve test, 漢字 and 12345 more\n\n  words " * 3
    raw = text.encode()
    spans = [(a, a + n) for a in range(-2, len(raw) + 3, 7) for n in (0, 1, 5, 40, 1000)] + [(None, 3), (4, None)]
    rows = [(i, text, a, b) for i, (a, b) in enumerate(spans)] + [(-1, None, 0, 5), (-2, "", 0, 5), (-3, "", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a int, b long").selectExpr("*", "1 AS offset", "2 AS start")
    coded = bpe.encode(docs, RANKS).join(docs.select("doc_id", "a", "b"), "doc_id")
    got = {r.doc_id: r for r in bpe.decode_spans(coded, RANKS, "a", "b").collect()}
    ids, packed = bpe.encode_texts([raw], RANKS)[0]
    starts = [*np.frombuffer(packed, "<u4").tolist(), len(raw)]
    assert library.encode_ordinary(text) == np.frombuffer(ids, "<u4").tolist()
    for i, (a, b) in enumerate(spans):
        if a is None or b is None:
            assert got[i].text is None
            continue
        met = [k for k in range(len(starts) - 1) if starts[k] < b and starts[k + 1] > a] if a < b else []
        want = raw[starts[met[0]] : starts[met[-1] + 1]] if met else b""
        assert bytes(got[i].text) == want, (a, b)
        if met:
            assert got[i].offset == starts[met[0]]
    assert all(bytes(got[i].text) == b"" for i in (-1, -2, -3))
    whole = bpe.encode(docs, RANKS, decoded=True)
    assert whole.columns == ["doc_id", "ids", "offsets", "decoded"]
