"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from meterflow.llm import variants
from meterflow.llm.common import read

SF_DIR = "/root/testdata/sf0.001"


def near(a: str, b: str) -> bool:
    """One inserted, deleted or replaced letter."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def plain(rows) -> dict[str, tuple]:
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    words = {w: c for w, c in n.items() if c >= 2}
    # Words one edit apart share a word that is one of them or one of them without a letter.
    places = defaultdict(set)
    for w in words:
        for cut in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))} if len(w) < 100 else {w[:7], w[-7:]}:
            places[cut].add(w)
    around = defaultdict(set)
    for group in places.values():
        for a in group:
            around[a] |= {b for b in group if near(a, b)}
    form = {}
    for w in words:
        if around[w]:
            best = min(around[w], key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(around[w]), words[form[w]] if w in form else None)
    return out


def check(docs, rows):
    got = variants.variants(docs).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain(rows)
    assert len({r.word for r in got}) == len(got)


def test_rows_of_any_kind(spark):
    rng = random.Random(12)
    base = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abcdefgh", "ÀÉabcdefÿ", "prefixes", "prefixed", "prefixe", "suffixes", "common"]
    words = list(base)
    for w in base * 12:
        k = rng.randrange(len(w) + 1)
        words.append(rng.choice([w[:k] + rng.choice("abxé") + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice("abyz×") + w[k + 1 :]]))
    rows = [(i, " ".join(rng.choices(words, k=40)).title()) for i in range(150)]
    rows += [(i, "abcdefgh " * 200 + "prefixes1prefixes" * 60) for i in range(3)]
    rows += [(7, "abcdefgh"), (7, "abcdefgh"), (None, "prefixe prefixes prefixe"), (8, None), (9, ""), (10, "1 2 3")]
    long = "".join(rng.choices("abcd", k=200_000))
    rows += [(11, f"{long} {long}"), (12, f"{long[:100_000]}{long[100_001:]} " * 2), (13, f"{long}x {long}x"), (14, f"b{long}x b{long}x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS n", "3 AS word", "4 AS node")
    check(docs, rows)
    assert variants.variants(docs.limit(0)).count() == 0


def test_crowded_nodes_are_split(spark, monkeypatch):
    monkeypatch.setattr(variants, "CROWD", 8)
    rng = random.Random(5)
    rows = [(i, " ".join("stems" + "".join(rng.choices("abc", k=rng.randrange(2, 6))) for _ in range(30))) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_chains_of_forms(spark):
    words = {"chained": 2, "chaine": 0, "chainedx": 20, "chainedxy": 200, "chainedxyz": 2000}
    rows = [(i, f"{w} " * n) for i, (w, n) in enumerate(words.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain(rows)
    check(docs, rows)
    assert len({root for _, root, *_ in expected.values()}) < len(expected)


def test_a_whole_table(spark):
    docs = read(spark, SF_DIR, "documents")
    check(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
