"""Language identification: fused evidence against plain Python, held-out accuracy, odd rows."""

from __future__ import annotations

import random

import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from meterflow.llm import langid, queries

SF_DIR = "/root/testdata/sf0.01"
EN = "the cat sat with the other thing and then the weather changed for them"
DE = "der hund und die katze sind nicht gleich aber schön und schnell gewesen"


def test_languages_of_the_documents(spark):
    """Declarations hidden from the model are found again."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    hidden = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    shown = docs.withColumn("lang", F.when(~hidden, F.col("lang")))
    got = {r.doc_id: r for r in langid.identify(shown).collect()}
    truth = {r.doc_id: r.lang for r in docs.filter(hidden).filter("n_chars > 40").collect()}
    right = np.mean([got[i].lang_id == lang for i, lang in truth.items()])
    assert right >= 0.97
    assert np.mean([got[i].kept for i in truth]) >= 0.99
    assert len(got) == docs.count()


def test_query_covers_every_document(spark):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.001")
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_odd_rows(spark):
    rows = [(i, EN, "en", "h.example.com") for i in range(8)] + [(20 + i, DE, "de", "k.example.org") for i in range(8)]
    rows += [(40, None, "en", "h.example.com"), (41, "", None, None), (42, "12 34", "de", None), (43, DE, None, None)]
    rows += [(43, DE, None, None), (None, EN, "de", ""), (44, "the and them " * 100_000, None, "h.example.com"), (45, "x", None, "k.example.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS _logs", "2 AS kept")
    got = langid.identify(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].kept for i in (0, 20, 40, 41, 42, 43, 44)] == [True, True, False, False, False, True, True]
    assert by[43].lang_id == "de" and by[44].lang_id == "en" and by[None].lang_id == "en"
    assert by[45].lang_id == "de"  # only the host tells
    assert by[40].lang_id is None and by[40].belief is None
    assert langid.identify(docs.limit(0)).count() == 0
    silent = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_id for r in silent} == {None} and sum(r.kept for r in silent) == 8 + 8 + 5


def test_evidence_equals_plain_counts(spark):
    languages = ["de", "en"]
    rows = [("a.x.com", "en", "en", 30), ("a.x.com", "de", "de", 5), ("b.x.com", "en", "en", 3), ("c.org", "de", "en", 4), (None, "de", None, 6)]
    counts = spark.createDataFrame(rows, "_host string, _learned string, _declared string, _n long")
    total = spark.createDataFrame([(0.4, 0.6)], "_p0 double, _p1 double")
    got = {r["_host"]: r["_prior"] for r in langid.host_priors(counts, total, languages).collect()}
    host, domain = defaultdict(Counter), defaultdict(Counter)
    for h, lang, _, n in rows:
        if h:
            host[h][lang] += n
            domain[".".join(h.split(".")[-2:])][lang] += n
    w = langid.HOST_WEIGHT
    for h, counted in host.items():
        d = domain[".".join(h.split(".")[-2:])]
        for i, lang in enumerate(languages):
            parent = (d[lang] + w * (0.4, 0.6)[i]) / (d.total() + w)
            assert math.isclose(got[h][i], math.log((counted[lang] + w * parent) / (counted.total() + w)), rel_tol=1e-9)
    like = {r["_declared"]: r["_declared_like"] for r in langid.value_likelihoods(counts, "_declared", languages).collect()}
    v = langid.VALUE_WEIGHT
    assert math.isclose(like["en"][0], math.log((4 + v / 2) / (9 + v))) and math.isclose(like["de"][1], math.log((v / 2) / (33 + v)))


def test_rare_and_many_languages(spark, monkeypatch):
    """A language of three documents is learned beside a large one, and so is each of over 64 languages."""
    monkeypatch.setattr(langid, "ROWS_PER_LANGUAGE", 20)
    names = [f"l{i:02}" for i in range(70)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {name: " ".join(letters[(i * k + k * k) % 26] + letters[(i + 3 * k) % 26] + letters[(i // 26 + 7 * k) % 26] for k in range(1, 60)) for i, name in enumerate(names)}
    rows = [(1000 * i + k, words[name], name, f"{name}.example") for i, name in enumerate(names) for k in range(3)]
    rows += [(100_000 + i, EN, "en", "en.example") for i in range(2000)] + [(200_000 + i, EN, None, None) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert langid.fit(docs, "doc_id", "text", "lang")[0] == ["en", *names]
    got = langid.identify(docs).filter("doc_id < 200000").groupBy("doc_id").agg(F.first("lang_id").alias("found")).collect()
    truth = {row[0]: row[2] for row in rows}
    assert all(r.found == truth[r.doc_id] for r in got) and len(got) == 2210


def test_four_hundred_declared_values(spark):
    """The plan must not grow with the number of languages."""
    rng = random.Random(4)
    sounds = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(6)] for _ in range(400)]
    rows = [(i, " ".join(rng.choices(sounds[i % 400], k=30)), f"l{i % 400:03}", f"h{i % 7}.com") for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = langid.identify(docs).collect()
    assert len(got) == 1600
    assert sum(r.lang_id == f"l{r.doc_id % 400:03}" for r in got) > 1580


def test_evidence_columns_may_exist_already(spark):
    rows = [(1, "the cat", "en", "a.com"), (2, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "7 AS _markup", "8 AS _tld", "9 AS _from", "10 AS _id", "11 AS page", "12 AS url", "13 AS _page")
    pages = spark.createDataFrame([("http://x.fr/1", "<html lang=\"fr\">")], "url string, html string").selectExpr("*", "1 AS doc_id", "2 AS lang")
    got = {r.doc_id: r for r in langid.with_addresses(docs, pages).collect()}
    assert (got[1]["_markup"], got[1]["_tld"], got[1]["_from"]) == ("fr", "fr", "x.fr")
    assert (got[2]["_markup"], got[2]["_tld"], got[2]["_from"]) == (None, None, None)
