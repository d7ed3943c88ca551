"""URL rules and the language-model ratio against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterflow.llm import urls


def plain_split(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host: str, path: str) -> tuple[str, str] | None:
    fits = []
    for rule, verdict in urls.RULES:
        own, slash, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else None


def rows():
    out = [(i, f"http://good.site{i % 7}.com/page/{i % 13}") for i in range(120)]
    out += [(200 + i, f"http://bad.spam{i % 5}.net/es/win/{i % 11}") for i in range(100)]
    out += [(400, "http://good.site3.org/page/4"), (401, "http://xx.spam2.org/es/win/3"), (402, None), (403, "no address"), (404, "")]
    out += [(405, "http://WWW.Example.COM/en/x?y#z"), (406, "http://a.example.com/en/"), (407, "http://example.com"), (408, "HTTP://notcom/"), (409, "x://É.net/fr/ü?")]
    out += [(410, "http://a.org/" + "p/" * 20_000), (0, out[0][1]), (0, out[0][1]), (None, "http://h.net/fr/")]
    return out


def test_rules_and_rows_of_any_kind(spark):
    pages = spark.createDataFrame(rows(), "page_id long, url string").selectExpr("*", "1 AS host", "2 AS score", "3 AS copies")
    got = urls.judge(pages).collect()
    assert sorted((r.page_id is None, r.page_id) for r in got) == sorted((i is None, i) for i, _ in rows())
    by = {r.page_id: r for r in got}
    for key, url in rows():
        host, path = plain_split(url)
        ruled = plain_rule(host, path)
        assert (by[key].host, by[key].path, by[key].rule) == (host, path, ruled[0] if ruled else None)
        if ruled:
            assert by[key].verdict == ruled[1]
    assert [by[i].verdict for i in (400, 401, 402, 403)] == ["allow", "block", "allow", "allow"]
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(pages.filter("page_id IN (400, 401)")).collect()} == {"allow"}


def test_ratio_equals_the_models(spark):
    sample = [(k, u, h, p, 1, (plain_rule(h, p) or ("", ""))[1] == "allow") for k, u in rows()[:220] for h, p in [plain_split(u)]]
    table = spark.createDataFrame(sample, "_key long, _url string, host string, path string, copies long, accepted boolean")
    counts = {True: Counter(), False: Counter()}
    for _, _, h, p, _, accepted in sample:
        text = urls.BEGIN * 3 + h + p + urls.END
        for at in range(3, len(text)):
            for k in range(4):
                counts[accepted][text[at - k : at + 1]] += 1
    totals = {y: Counter() for y in counts}
    for y, own in counts.items():
        for gram, n in own.items():
            totals[y][len(gram) - 1, gram[:-1]] += n
    kept = {g for g in counts[True] | counts[False] if counts[True][g] + counts[False][g] >= 2}

    def probability(gram: str, y: bool) -> float:
        k = len(gram) - 1
        n = counts[y][gram] if gram in kept else 0
        if k == 0:
            return (n + 1) / (totals[y][0, ""] + urls.ALPHABET)
        known = any((g[:-1], len(g)) == (gram[:-1], len(gram)) for g in kept)
        lower = probability(gram[1:], y)
        return (n + urls.SMOOTHING * lower) / (totals[y][k, gram[:-1]] + urls.SMOOTHING) if known else lower

    scored = urls.score(table, urls.fit(table), "_key", "_url")
    for row in scored.filter("_key IN (3, 50, 201, 250)").collect():
        text = urls.BEGIN * 3 + "".join(plain_split(row["_url"])) + urls.END
        ratio = sum(
            math.log(probability(text[at - 3 : at + 1], True) / probability(text[at - 3 : at + 1], False)) for at in range(3, len(text))
        )
        assert row.score == pytest.approx(ratio / (len(text) - 3), abs=1e-9)


def test_a_large_table_keeps_rare_grams(spark):
    rows = [("a.com", "/page", True, 1_000_000), ("b.net", "/es/x", False, 1_000_000), ("c.com", "/qzj", True, 2), ("d.com", "/w", True, 1)]
    table = spark.createDataFrame(rows, "host string, path string, accepted boolean, copies long")
    grams = {r.gram for r in urls.fit(table).collect()}
    assert {"qzj", "/qzj", f"qzj{urls.END}"} <= grams and "m/w" not in grams
    parts = urls.score(table.withColumn("_key", F.col("path")), urls.fit(table), "_key").collect()
    assert {r["_key"]: r.score > 0 for r in parts} == {"/page": True, "/es/x": False, "/qzj": True, "/w": True}


@pytest.mark.parametrize("accepted, rejected, cut", [
    ([4.6, 5.2, 6.0], [-5.3, -7.1], 0.0),  # a wide gap: the cut nearest to 0
    ([1.31, 2.0], [-3.0, 0.52, 0.61], 0.65),
    ([-2.0, -1.01], [-4.0, -3.3], -2.0),
    ([-1.0, 3.0, 3.1], [-2.0, 1.0, 1.2, 1.41], 1.45),
    ([0.7], [], 0.0),
    ([], [], 0.0),
    ([50.0, 30.0], [-50.0], 0.0),
])
def test_threshold_equals_plain_python(spark, accepted, rejected, cut):
    rows = [(x, True, 1) for x in accepted] + [(x, False, 2) for x in rejected]
    scored = spark.createDataFrame(rows, "score double, accepted boolean, copies long")
    found = urls.threshold(scored).first().cut
    if accepted and rejected:

        def rate(at: float) -> float:
            return sum(x >= at for x in accepted) / len(accepted) + sum(x < at for x in rejected) / len(rejected)

        every = [k * urls.CUT_STEP for k in range(-200, 201)]
        assert found == pytest.approx(min(every, key=lambda at: (-round(rate(at), 9), abs(at), at)))
    assert found == pytest.approx(cut)
