"""Divergence of sources against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

import __spark_entry__ as entry
from meterflow.llm import divergence
from tests.check import compare, database

SF_DIR = "/root/testdata/sf0.001"


def plain(rows) -> set[tuple]:
    """The whole audit of rows (text, lang, source) by definition."""
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in documents[lang].items() if n >= 10]
        own = [s for x, s in groups if x == lang]

        def shares(chosen, kept=kept):
            n = {t: sum(counts[g][t] for g in chosen) for t in kept}
            total = sum(n.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (n[t] + 2) // total for t in kept}

        p, q = shares([(lang, source)]), shares([(lang, s) for s in own])
        pairs = []
        for other in own:
            if other != source:
                r = shares([(lang, other)])
                pairs.append((-sum((p[t] - r[t]) ** 2 // (p[t] + r[t]) for t in kept), other.encode()))
        terms = [(-((p[t] - q[t]) ** 2 // (p[t] + q[t])), t.encode()) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
            out |= {(lang, source, part, item.decode(), -value, k) for k, (value, item) in enumerate(found, 1)}
    return out


def test_rows_of_any_kind(spark):
    rng = random.Random(13)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(60)] + ["É", "é", "漢字", "A", "ß😀"]
    rows = []
    for i in range(700):
        source = None if i % 50 == 0 else f"s{rng.randrange(70)}" if i % 3 else "hot"
        lang = rng.choice(["en", "fr", None, "EN"])
        rows.append((" ".join(rng.choices(words[: rng.choice([5, 20, 65])], k=rng.randrange(0, 30))), lang, source))
    rows += [(None, "en", "empty"), ("", "en", "empty"), ("1 2 3 _", "xx", "a"), ("rare", "xx", "b"), ("rare", "xx", "b"), ("x " * 50_000 + "wak", "en", "long")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS term", "2 AS n", "3 AS value", "4 AS number")
    got = [tuple(r) for r in divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_blocks_change_nothing(spark, monkeypatch):
    rows = [(f"{'abcdefgh'[i % 8]}x {'abcde'[i % 5]}y common", "en", f"s{i % 3}") for i in range(200)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(divergence, "BLOCK", 4)
    assert {tuple(r) for r in divergence.audit(docs).collect()} == plain(rows)


def test_runs_hold_the_column():
    rng = np.random.default_rng(13)
    for _ in range(300):
        length = int(rng.integers(1, 40))
        columns = []
        for _ in range(2):
            column = np.where(rng.random(length) < 0.5, 7, rng.integers(1, 4, length) * 10**8)
            places = rng.permutation(np.flatnonzero(column != 7))
            starts, values = divergence._runs(places, column[places], 7, length)
            assert starts[0] == 0 and (np.diff(starts) > 0).all() and (values[1:] != values[:-1]).all()
            assert (values[np.searchsorted(starts, np.arange(length), "right") - 1] == column).all()
            columns.append((column, (starts, values)))
        (p, a), (q, b) = columns
        assert divergence.run_difference(a, b, length) == ((p - q) ** 2 // (p + q)).sum()


def test_counts_beyond_64_bits_of_product(spark):
    big = spark.createDataFrame([(10**15, 10**16, 10**6)], "n long, total long, terms long")
    row = big.select(*(divergence.probability(*(divergence.F.col(c) for c in big.columns)).alias("p"),)).first()
    assert row.p == 1 + 10**9 * (10**15 + 2) // (10**16 + 2 * 10**6)


def test_query_equals_sql(spark):
    found = entry.queries()["op13_divergence"](spark, SF_DIR)
    assert compare(found, database(SF_DIR), entry.oracle_sql()["op13_divergence"]) is None
