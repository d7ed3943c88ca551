"""Quality counts and host verdicts against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

from meterflow.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(hit),
    )


def test_counts():
    rng = random.Random(4)
    parts = ["a", "b", "é", "c#", "\n", " ", "\t", "\x0b", "\x1c", "\x85", " ", "<>", " a b ", "x\ny"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(3000)]
    for text in [*texts, "", "a a a a", "a b c a b c", "\n\n", " \n \n"]:
        assert quality.text_stats(text.encode()) == plain(text), repr(text)


def test_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, good, "fine") for i in range(40)] + [(100 + i, bad, "poor") for i in range(40)]
    rows += [(200, good, "poor"), (201, good, "new"), (202, bad, "new"), (203, good, None), (None, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS kept", "2 AS _host")
    got = quality.quality(docs.drop("_host")).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert len(got) == len(rows)
    assert all(kept[i] for i in range(40)) and not kept[200] and kept[201] and not kept[202]
    assert kept[203] and kept[None] is False
    hosts = {"fine": (40, 0), "poor": (41, 40), "new": (2, 1), None: (1, 0), "": (1, 1)}
    n = sum(a for a, _ in hosts.values())
    mean = sum(b for _, b in hosts.values()) / n
    spread = (sum(b * b / a for a, b in hosts.values()) - n * mean * mean) / (mean * (1 - mean))
    shared = (spread - len(hosts)) / (n - len(hosts))
    weight = min(max(1 / shared - 1, 1), 1000)
    evidence = [(a / (1 + (a - 1) / (weight + 1)), b / a) for a, b in hosts.values()]
    mean = sum(w * rate for w, rate in evidence) / sum(w for w, _ in evidence)
    for row in quality.host_rates(quality.document_stats(docs.drop("_host"))).collect():
        a, b = hosts[row["_host"]]
        assert abs(row.shrunk_rate - (b + mean * weight) / (a + weight)) < 1e-12
    assert quality.quality(docs.limit(0)).count() == 0


def test_long_and_repeated(spark):
    text = "alpha beta gamma " * 100_000
    docs = spark.createDataFrame([(1, text, "h")] * 2, "doc_id long, text string, source string")
    rows = quality.quality(docs).collect()
    assert [(r.n_words, r.n_repeat_words, r.base_failed) for r in rows] == [(300_000, 300_000, True)] * 2


def test_small_hosts_do_not_look_different_by_chance(spark):
    """Hosts of one rate give a strong prior, and one host of a third of all rows does not set it."""
    rng = random.Random(2)
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, bad if rng.random() < 0.3 else good, f"h{i % 150}") for i in range(600)]
    rows += [(1000 + i, bad, "two") for i in range(2)] + [(1100, good, "two")]
    rows += [(2000 + i, bad, "spam") for i in range(300)] + [(2400, good, "spam")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few = quality.host_rates(quality.document_stats(docs.filter("source <> 'spam'"))).collect()
    assert max(r.shrunk_rate for r in few) < 0.5
    kept = {r.doc_id: r.kept for r in quality.quality(docs).collect()}
    assert not kept[2400]  # a planted host takes its one good document along
    assert kept[1100]


def test_equals_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(9)
    parts = ["a", "b", "é", "c#", "\n", " ", "\t", "\x0b", "\x1c", "\x85", "\u00a0", "<>", " a b ", "x\ny"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(400))), rng.choice(["p", "q", None])) for i in range(300)]
    rows += [(300, None, "r"), (300, "", None), (None, "a a a a", "p"), (301, "a a a a", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    mine = quality.quality(docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(quality.ORACLE)
    names = [c[0] for c in result.description]
    theirs = sorted(map(repr, result.fetchall()))
    found = [tuple(round(r[n] + 1e-9, 6) if n == "host_rate" else r[n] for n in names) for r in mine.collect()]
    assert sorted(map(repr, found)) == theirs
