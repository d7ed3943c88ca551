"""Secret spans against Python's regular expressions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from meterflow.llm import secrets
from meterflow.llm.queries import secret_digests

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = [re.compile(ASSIGN, re.I | re.A), re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")]
LEAST = [6, 20, 24]


def plain(text: str) -> list[tuple[int, int, int]]:
    found = [
        (m.start(), m.end(), k)
        for k, pattern in enumerate(PATTERNS)
        for m in pattern.finditer(text)
        if len(m[2] if k == 0 else m[0]) >= LEAST[k]
    ]
    return sorted(found, key=lambda s: (s[0], s[2]))


def odd_texts() -> list[str]:
    rng = random.Random(2)
    parts = [
        "token", "Secret", "api_key", "APIKEY", "password", "passwd", ":", "=", "'", '"', " ", "  ",
        "abc", "abcdef1", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "\n", "é", "-", "/", ".", "ſecret",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(4000)]
    return [*texts, "", "a" * 50_000, "0f" * 3000, "token=secret=abcdefgh", "secret: token: abcdef123"]


def test_base_spans():
    texts = odd_texts()
    found = secrets.scanner(secrets.RULES).spans([t.encode() for t in texts])
    for text, spans in zip(texts, found, strict=True):
        assert [s for s in spans if s[2] < 3] == plain(text), repr(text[:200])


def test_minimised_automaton_accepts_the_same():
    rules = (secrets.Rule("a", "a(b|cd)*e"), secrets.Rule("b", "[a-c]{2,3}x?"))
    dfa = secrets.compile_rules(rules, search=False)
    patterns = [re.compile("a(b|cd)*e"), re.compile("[a-c]{2,3}x?")]
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices("abcdex", k=rng.randrange(8)))
        state = 0
        for byte in text.encode():
            state = dfa.step[state, dfa.class_of[byte]]
        bits = sum(1 << k for k, p in enumerate(patterns) if p.fullmatch(text))
        assert dfa.accepts[state] == bits, text


def test_further_rules():
    key = "gho_" + "A1b2" * 9
    text = f"é {key} xoxb-1234567890 -----BEGIN RSA PRIVATE KEY-----"
    spans = secrets.scanner(secrets.RULES).spans([text.encode()])[0]
    assert [(text[a:b], secrets.RULES[k].kind) for a, b, k in spans] == [
        (key, "forge_token"), ("xoxb-1234567890", "chat_token"),
        ("-----BEGIN RSA PRIVATE KEY-----", "private_key"),
    ]


def test_rows_of_any_kind(spark):
    long = "word " * 200_000 + "password=hunter22x"
    rows = [(1, "x token: abcdef1"), (1, "x token: abcdef1"), (2, None), (3, ""), (None, "é 0123456789abcdef01234567"), (5, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS kind")
    got = sorted(secret_digests(docs).collect(), key=lambda r: r.doc_id or 0)
    assert [r.spans for r in got] == [
        "hex:2:26", "assign:2:16", "assign:2:16", "", "", f"assign:1000000:{len(long)}",
    ]
    assert got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[1].base_sha256 == hashlib.sha256(b"assign:2:16").hexdigest() and got[1].n_assign == 1
    clean = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert clean[1] == "x <assign>" and clean[2] is None and clean[None] == "é <hex>"
    assert secrets.redact(docs.limit(0)).count() == 0 == secret_digests(docs.limit(0)).count()


def test_scan_in_lanes_equals_one_state_at_a_time():
    scanner = secrets.scanner(secrets.RULES)
    raw = " and ".join(odd_texts()[:300]).encode()
    state, seen = 0, 0
    for c in scanner.all.class_of[np.frombuffer(raw, dtype=np.uint8)]:
        state = scanner.all.step[state, c]
        seen |= int(scanner.all.accepts[state])
    bits = 0
    for _, _, found in scanner.flagged(np.frombuffer(raw, dtype=np.uint8)):
        bits |= found
    assert bits == seen
