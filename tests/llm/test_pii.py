"""Personal data: patterns against Python's, revealing terms, sanitised texts, odd rows."""

from __future__ import annotations

import hashlib
import random
import re

from meterflow.llm import pii
from meterflow.llm.queries import digests

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string"


def passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        twice = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return True


def plain(text: str | None) -> str:
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PATTERNS.items() for m in re.finditer(pattern, text or "") if passes(kind, m[0])
    )


def test_patterns(spark):
    rng = random.Random(7)
    parts = ["a@b.co", "x", "_", "@", ".", "12", "255", "1.2.3.4", "300", " ", "-", "+", "4406265717522065", "(", ")", "é", "\n", "4", "+1 (459) 555-7415", "00001", "😀"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(1, 14)))) for i in range(4000)]
    rows += [(5000, "1" * 50_000), (5001, "a" * 50_000), (5002, "1 " * 30_000), (5003, "+" + "1" * 50_000), (5004, "1." * 30_000), (5005, "a@b.cc_x@y.z")]
    rows += [(5100 + n, "é mail p7@x7.org or 10.0.2.9 " * n) for n in (127, 128, 129, 256, 5000)]
    got = {r.doc_id: r.spans for r in digests(pii.find(spark.createDataFrame(rows, SCHEMA)), list(pii.KINDS)).collect()}
    for key, text in rows:
        assert ",".join(s for s in got[key].split(",") if not s.startswith("term")) == plain(text), repr(text[:200])


def corpus() -> list[tuple[int, str]]:
    rng = random.Random(1)
    common = ["alpha", "bravo", "delta", "gamma", "omega", "sigma", "theta", "kappa"]
    rows = [(i, " ".join(rng.choices(common, k=30))) for i in [*range(300), *range(700, 1100)]]
    for i in range(6):  # one person's odd name stands beside their address in different contexts
        rows.append((400 + i, f"{' '.join(rng.choices(common, k=9))} Zyxwald jane@example.org {' '.join(rng.choices(common, k=9))}"))
    rows += [(500 + i, "copied Qwertyus passage bob@example.org of many documents") for i in range(20)]
    return [*rows, (600, "nothing but zyxwald here")]


def test_terms_that_reveal_an_entity(spark):
    rows = corpus()
    found = pii.find(spark.createDataFrame(rows, SCHEMA))
    terms = {r.doc_id: [r.text[s.start : s.stop] for s in r.spans if s.kind == "term"] for r in found.collect()}
    assert terms[600] == ["zyxwald"] and all(terms[400 + i] == ["Zyxwald"] for i in range(6))
    assert not any(terms[i] for i in [*range(300), *range(700, 1100)]) and not any(terms[500 + i] for i in range(20))
    clean = {r.doc_id: r.text for r in pii.sanitise(found).collect()}
    assert clean[600] == "nothing but  here" and clean[500] == "copied Qwertyus passage <email> of many documents"
    assert clean[0] == rows[0][1]


def test_rows_of_any_kind(spark):
    rows = [(1, "é a@b.co"), (1, "é a@b.co"), (2, None), (3, ""), (None, "1.2.3.4"), (5, "word " * 100_000 + "a@b.co")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS spans", "2 AS base", "3 AS terms")
    got = sorted(digests(pii.find(docs), list(pii.KINDS)).collect(), key=lambda r: r.doc_id or 0)
    assert [r.spans for r in got] == ["ip:0:7", "email:2:8", "email:2:8", "", "", "email:500000:500006"]
    assert got[3].base_sha256 == hashlib.sha256(b"").hexdigest() and got[1].n_email == 1
    assert pii.find(docs.limit(0)).count() == 0


def test_terms_far_from_frequent_entities(spark):
    """A short name sentences away from the address that a third of a small table shares."""
    rng = random.Random(5)
    common = ["alpha", "bravo", "delta", "gamma", "omega", "sigma", "theta", "kappa"]

    def prose(n: int) -> str:
        return " ".join(rng.choices(common, k=n))

    rows = [(i, f"\u674e\u660e wrote. {prose(30)}. {prose(6)} hot@example.org {prose(6)}") for i in range(20)]
    rows += [(100 + i, prose(40)) for i in range(40)] + [(200, "by \u674e\u660e alone")]
    found = pii.find(spark.createDataFrame(rows, SCHEMA))
    terms = {r.doc_id: {r.text[s.start : s.stop] for s in r.spans if s.kind == "term"} for r in found.collect()}
    assert all("\u674e\u660e" in terms[i] for i in [*range(20), 200])
    assert not any(terms[100 + i] for i in range(40)) and not any(set(common) & t for t in terms.values())
