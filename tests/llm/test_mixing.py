"""Mixing: the exponent, quotas and block permutations against plain Python."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from meterflow.llm import mixing

TOKENS = {"big": 9000, "mid": 900, "small": 90, "": 45}


def documents(spark):
    rows = []
    for source, total in TOKENS.items():
        each = 45 if source == "big" else 15
        rows += [(len(rows) + k, "w " * each, source) for k in range(total // each)]
    rows += [(9000 + k, None, None) for k in range(3)] + [(9100, "", "big")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS weight", "2 AS block", "3 AS _n", "4 AS epoch"
    )


def plain_exponent(meets) -> float:
    low, high = 0.0, 1.0
    if meets(1.0):
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if meets(mid) else (low, mid)
    return low


def least_exponent(repeats: float) -> float:
    return 1 - plain_exponent(lambda x: (9000 / 45) ** x <= repeats)


def entropy_of(t: float) -> float:
    weights = [n**t for n in TOKENS.values()]
    return -sum(w / sum(weights) * math.log(w / sum(weights)) for w in weights)


@pytest.mark.parametrize("goal", [{"entropy": 0.8}, {"entropy": 0.1}, {"repeats": 3.0}, {"repeats": 1e6}])
def test_exponent(spark, goal):
    rows = [(k, 1, n) for k, n in TOKENS.items()] + [("none", 3, 0)]
    sources = spark.createDataFrame(rows, "_source string, _docs long, _tokens long")
    if "entropy" in goal:
        expected = plain_exponent(lambda t: entropy_of(t) >= goal["entropy"] * math.log(4))
    else:
        expected = least_exponent(goal["repeats"])
    assert mixing.find_exponent(sources, **goal) == pytest.approx(expected, abs=1e-6)


def test_every_document_stays_and_quotas_are_met(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 8)
    docs = documents(spark)
    rows = mixing.mix(docs, repeats=3.0).collect()
    times = Counter(r.doc_id for r in rows)
    assert set(times) == {r.doc_id for r in docs.collect()}
    t = least_exponent(3)
    most = max(n / n**t for n in TOKENS.values())
    used = Counter()
    for r in rows:
        used[r.source] += r.n_tokens
    for source, n in TOKENS.items():
        assert abs(used[source] - n**t * most) <= 46  # up to one document over
    assert used[None] == 0 and [times[9000 + k] for k in range(3)] == [1, 1, 1]
    places = defaultdict(list)
    for r in rows:
        places[r.source, r.epoch].append(r.position)
    whole = Counter(r.source for r in docs.collect())
    for (source, epoch), positions in places.items():
        assert sorted(positions) == list(range(len(positions)))
        assert len(positions) == whole[source] or epoch == max(e for s, e in places if s == source)
    orders = [[r.doc_id for r in sorted(rows, key=lambda r: r.position) if (r.source, r.epoch) == ("small", e)] for e in (0, 1)]
    assert set(orders[0]) == set(orders[1]) and orders[0] != orders[1]


def test_budget_and_application(spark):
    docs = documents(spark)
    plan = mixing.mix(docs, entropy=1.0, budget=720)
    used = {r.source: r.n for r in plan.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    assert all(180 <= used[s] < 226 for s in TOKENS)
    out = mixing.apply_mix(docs, plan)
    assert out.columns == docs.columns and out.count() == plan.count()
    assert mixing.mix(docs.limit(0), repeats=2.0).count() == 0


def test_repeated_rows_share_decisions_and_missing_keys_stay(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "c", "s"), (2, "long " * 100_000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix(docs, repeats=1.0)
    assert Counter(r.doc_id for r in mixing.apply_mix(docs, plan).collect()) == {1: 2, None: 1, 2: 1}
