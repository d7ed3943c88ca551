"""The pipeline on a small folder against plain Python: every stage's decisions take effect."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np

import corpus_pipeline as pipeline
from meterflow.llm.common import read

from .test_bpe import library  # noqa: F401, a fixture
from .test_minhash import plain_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SECRET = "password = hunter22x"


def rows() -> list[tuple]:
    rng = random.Random(11)
    words = ["river", "garden", "window", "summer", "paper", "market", "winter", "yellow", "forest", "silver", "copper"]

    def text(n: int) -> str:
        return " ".join(rng.choices(words, k=n))

    texts = {i: text(80) for i in range(60)}
    copied = texts[3].split()
    copied[40] = "altered"
    texts |= {60: texts[1], 61: texts[2].upper(), 62: " ".join(copied), 63: f"{text(40)} {SECRET} {text(40)}", 64: text(30_000)}
    texts |= {65: None, 66: "", 67: "12 34 --", 68: texts[1]}
    sources = {i: "small" if i % 6 == 0 and i < 60 else "big" for i in texts}
    return [(i, t, "en", sources[i], None if t is None else len(t)) for i, t in texts.items()]


def expected(documents: list[tuple], tokens) -> Counter:
    """``(doc_id, n_tokens, ids, decoded)``; big holds over twice small's words, so small is used twice."""
    read_ones = [(i, t, source) for i, t, _, source, _ in documents if t and re.search("[A-Za-z]", t)]
    group = plain_groups([(i, t) for i, t, _ in read_ones])
    found: Counter = Counter()
    for i, text, source in read_ones:
        if group[i] == i:
            clean = text.replace(SECRET, "<assign>")
            ids = np.array(tokens.encode_ordinary(clean), dtype="<u4").tobytes()
            row = (i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(clean.encode()).hexdigest())
            found[row] += 2 if source == "small" else 1
    return found


def test_pipeline_equals_plain_python(spark, tmp_path, library):  # noqa: F811
    documents = rows()
    spark.createDataFrame(documents, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = pipeline.run(spark, str(tmp_path)).collect()
    want = expected(documents, library)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert not {row[0] for row in want} & {60, 61, 62, 65, 66, 67, 68}


def test_stages_keep_the_columns_of_documents(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "minhash_near_dedup", "secret_scan", "mix_sources", "byte_bpe"]
    for _, function in pipeline.STAGES[:-1]:
        assert function(spark, docs, "/root/testdata/sf0.001").dtypes == docs.dtypes


def test_near_duplicates_from_four_fifths(spark):
    words = [f"w{i}" for i in range(200)]
    altered = [f"x{i}" if i in (30, 80, 120, 170) else w for i, w in enumerate(words)]  # Jaccard 176 / 216
    far = [f"y{i}" if i in (20, 60, 100, 140, 180) else w for i, w in enumerate(words)]  # 171 / 221
    rows = [(i, " ".join(t), "en", "s", len(" ".join(t))) for i, t in enumerate((words, altered, far))]
    assert {r.doc_id for r in pipeline.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()} == {0, 2}
