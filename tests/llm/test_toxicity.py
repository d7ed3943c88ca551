"""Toxicity: edits against a plain distance, held-out accuracy, context, odd rows."""

from __future__ import annotations

import random

from meterflow.llm import toxicity
from meterflow.llm.queries import op4_toxicity

TERMS = {"idiot": 6.0, "moron": 6.0, "worthless": 6.0, "scum": 6.0, "loath*": 6.0}


def distance(a: str, b: str) -> int:
    """Edits with exchanges of neighbours, each letter edited once."""
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_equals_the_distance():
    trie, rng = toxicity.FuzzyTrie(TERMS), random.Random(3)
    words = [t.rstrip("*") for t in TERMS]
    for _ in range(20_000):
        word = list(rng.choice(words))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randrange(2)] = rng.choices("idotmrnwhlescua", k=rng.randrange(2))
            if len(word) > 2 and rng.random() < 0.3:
                at = rng.randrange(len(word) - 1)
                word[at], word[at + 1] = word[at + 1], word[at]
        word = "".join(word)
        near = [distance(word, t) for t in words[:4] if len(t) >= 5 or word == t]
        best = min([d for d in near if d <= 1] + [0] * word.startswith("loath"), default=None)
        found = trie.match(word)
        assert (found[1] if found else None) == best, word


def test_quotation_counts_against():
    model = toxicity.Model(terms={"idiot": 4.0}, context={toxicity.QUOTE: -2.0}, prior=-2.2)
    assert model.score("you idiot there") > toxicity.THRESHOLD > model.score('they wrote "you idiot there" again')


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in op4_toxicity(spark, sf_dir).collect() if r.doc_id in labels and r.held_out]
    caught = [r.predicted for r in rows if labels[r.doc_id]]
    wrong = [r.predicted for r in rows if not labels[r.doc_id]]
    assert sum(caught) >= 0.75 * len(caught) and sum(wrong) <= 0.01 * len(wrong)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_rows_of_any_kind(spark):
    docs = spark.createDataFrame(
        [(1, None), (1, None), (2, ""), (None, "x"), (4, "word " * 100_000)], "doc_id long, text string"
    ).selectExpr("*", "1 AS score", "2 AS toxic")
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (None, 1, 1), (4, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 5 and {round(r.score, 6) for r in got} == {0.05}
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_signs_and_digits_inside_words():
    model = toxicity.Model(terms={"idiot": 3.0, "moron": 3.0, "stupid": 3.0, "loath*": 3.0}, innocent={"mor-on"}, prior=0.0)
    clean = model.score("nothing here")
    for text in ("You ID1OT there", "a m0ron, x", "so st*pid", "st_pid", "id.iot", "x.m0ron", "idiot,moron", "stupix"):
        assert model.score(text) > toxicity.THRESHOLD > clean, text
    for text in ("mor-on", "i1d2iot", "id iot", "m0r0n", "12 34", "loa7hed", ""):
        assert model.score(text) == clean, text
    assert [(h[0], h[1], h[3]) for h in model.hits("a b-c m0ron d id1ot", toxicity.words_of("a b-c m0ron d id1ot"))] == [
        (3, "moron", "m0ron"), (6, "idiot", "id1ot")
    ]
