"""Near-duplicate groups against all pairs on a small fixture."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from meterflow.llm import minhash
from meterflow.llm.components import connected_components
from meterflow.session import stage_folder

SCHEMA = "doc_id long, text string"


def plain_set(text: str | None) -> set[tuple[str, ...]]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5)), strict=False))


def plain_groups(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    sets = {i: plain_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def family(rng: random.Random, start: int, n: int, edits: int, length: int = 200) -> list[tuple[int, str]]:
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        rows.append((start + k, " ".join(words)))
    return rows


def fixture() -> list[tuple[int, str | None]]:
    rng = random.Random(8)
    rows = family(rng, 0, 120, 4)  # most are linked
    rows += family(rng, 1000, 120, 9)  # about the threshold, chains
    rows += [(2000 + i, "Same text of A few words over and over") for i in range(50)]
    rows += [(2100, "SAME text of a few words over and over"), (2101, "same text of a few words  over\tand over")]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "one"), (3004, "ONE"), (3005, "one two"), (3006, "É x"), (3007, "é x")]
    sliding = [f"s{k}" for k in range(400)]
    rows += [(4000 + k, " ".join(sliding[3 * k : 3 * k + 100])) for k in range(60)]  # a chain of overlaps
    rng.shuffle(rows)
    return rows


def test_groups_equal_all_pairs(spark):
    rows = fixture()
    expected = plain_groups(rows)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS bands", "3 AS component_id")
    got = minhash.near_duplicates(docs.repartition(5)).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(plain_set(t)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_members_that_stars_miss(spark, monkeypatch):
    """Pairs of small chunks, where neither end of a band is similar to the rest."""
    monkeypatch.setattr(minhash, "CHUNK", 7)
    rng = random.Random(3)
    rows = [row for s in range(6) for row in family(rng, 100 * s, 30, 12, 150)]
    expected = plain_groups(rows)
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_repeated_rows_and_missing_keys(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, None), (5, text + " end"), (6, "word " * 200_000)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS source")
    got = minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (5, 1, False), (6, 6, True),
    ]
    left = minhash.keep_one(docs)
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 1, 6] and left.columns == docs.columns
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_estimate_follows_similarity(spark):
    rng = np.random.default_rng(1)
    rows = []
    for share in (0.5, 0.8, 0.9):
        a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        b = a.copy()
        n = round(4000 * (1 - share) / (1 + share))
        b[:n] = rng.integers(0, 2**63, n, dtype=np.uint64)
        hashes = np.concatenate([np.sort(a), np.sort(b)])
        packed = minhash.sketches(hashes, np.array([4000, 4000]))[2]
        rows.append((share, packed[0].tolist(), packed[1].tolist()))
    frame = spark.createDataFrame(rows, "share double, a array<long>, b array<long>")
    for row in frame.select("share", minhash.estimate(frame.a, frame.b).alias("found")).collect():
        assert row.found == pytest.approx(row.share, abs=0.15)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 180)] + [(0, i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(90)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(frame, stage_folder(spark)).collect()}
    parent = {i: i for e in edges for i in e}
    for _ in range(200):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {i: c for i, c in parent.items() if any(i in e and e[0] != e[1] for e in edges)}
    assert connected_components(frame.limit(0), stage_folder(spark)).count() == 0


def test_rows_of_one_key_are_told_apart(spark):
    near = " ".join(f"w{i}" for i in range(100))
    rows = [
        (1, "one two three four five six"), (1, "alpha beta gamma delta epsilon zeta"), (2, "alpha beta gamma delta epsilon zeta"),
        (3, near), (4, near + " end"), (4, "something else that has six words"), (5, None), (5, ""), (6, "x"), (6, "x"), (None, near),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS _row", "3 AS least", "4 AS rep", "5 AS _key")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == sorted([
        (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 96, 3, True), (4, 97, 3, False), (4, 2, 4, True),
        (5, 0, 5, True), (5, 0, 5, True), (6, 1, 6, True), (6, 1, 6, True), (0, 96, 0, True),
    ])
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert texts == sorted([
        (1, rows[0][1]), (1, rows[1][1]), (3, near), (4, rows[5][1]), (5, ""), (5, ""), (6, "x"), (0, near),
    ])
