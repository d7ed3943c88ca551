"""Nearest neighbours against brute force: recall, order, ties, odd rows."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest

from meterflow.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows: dict[int, np.ndarray], every: int, top: int) -> dict[int, list[tuple[int, float]]]:
    out = {}
    for q, x in rows.items():
        if q % every == 0:
            scored = sorted((-float((x.astype(np.float64) * y.astype(np.float64)).sum()), i) for i, y in rows.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:top]]
    return out


def test_recall_on_the_table(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    table = pq.read_table(path)
    rows = dict(zip(table.column("vec_id").to_pylist(), np.array(table.column("embedding").to_pylist(), dtype=np.float32), strict=True))
    expected = brute(rows, 20, 20)
    got: dict[int, list] = {}
    for r in ann.neighbours(spark.read.parquet(path)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == expected.keys()
    found = [len({i for _, i, _ in got[q]} & {i for i, _ in expected[q]}) / 20 for q in expected]
    assert np.mean(found) >= 0.9
    for q, rows_of in got.items():
        assert [r for r, _, _ in rows_of] == list(range(1, 21))
        assert [(-s, i) for _, i, s in rows_of] == sorted((-s, i) for _, i, s in rows_of)
        for _, i, s in rows_of:
            assert s == pytest.approx(float(rows[q].astype(np.float64) @ rows[i].astype(np.float64)), abs=1e-12)


def test_clusters_need_few_visits(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 16))
    points = (centers[rng.integers(0, 40, 3000)] + 0.05 * rng.normal(size=(3000, 16))).astype(np.float32)
    vectors = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], SCHEMA)
    index = ann.Index(vectors, "vec_id", "embedding")
    assert index.enough < 1500
    expected = brute(dict(enumerate(points)), 100, 20)
    got = ann.neighbours(vectors, every=100).collect()
    hit = sum(r.vec_id in {i for i, _ in expected[r.query_id]} for r in got)
    assert hit >= 0.9 * 20 * len(expected)


def test_crowded_blocks_are_copied_and_cells_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_CHUNK", 8)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "ENTRIES_PER_CELL", 100)
    monkeypatch.setattr(ann, "RECALL", 1.0)
    rng = np.random.default_rng(8)
    points = rng.normal(size=(900, 6)).astype(np.float32)
    index = ann.Index(spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], SCHEMA), "vec_id", "embedding")
    assert index.parts_of.max() > 1
    monkeypatch.setattr(index, "enough", index.n)
    queries = index.vectors.filter("key % 5 = 0").selectExpr("key AS query", "vector")
    got: dict[int, list] = {}
    for r in index.search(queries).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = brute(dict(enumerate(points)), 5, 20)
    assert {q: [i for i, _ in found] for q, found in got.items()} == {q: [i for i, _ in found] for q, found in expected.items()}


def test_ties_and_odd_rows(spark):
    same = [0.5, 0.5, 0.5]
    rows = [(i, same) for i in range(100)] + [(3, same), (200, [1.0, 0.0, 0.0]), (201, [0.0, 0.0, 0.0]), (202, None), (203, [1.0, None, 0.0])]
    rows += [(204, [float("nan"), 1.0, 1.0]), (205, [float("inf"), 0.0, 0.0]), (206, [1.0]), (220, []), (None, [1.0, 1.0, 1.0]), (240, same)]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS vector")
    got = {}
    for r in ann.neighbours(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {0, 20, 40, 60, 80, 200, 240}
    assert got[0] == list(range(1, 21)) and got[20] == list(range(20)) and got[240] == list(range(20))
    assert got[200] == list(range(20))
    few = ann.neighbours(vectors.filter("vec_id IN (0, 1, 200)")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in few] == [(0, 1), (0, 200), (200, 0), (200, 1)]
    assert ann.neighbours(vectors.limit(0)).count() == 0
    assert ann.neighbours(vectors.filter("vec_id = 20")).count() == 0


def test_walk_visits_cells_in_order():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=9), rng.normal(size=7)
    cells = ann.walk(a, b, np.ones(63, dtype=int), 63)
    sums = (a[:, None] + b[None, :]).ravel()
    assert sorted(cells) == list(range(63)) and np.all(np.diff(sums[cells]) <= 1e-12)
    assert len(ann.walk(a, b, np.ones(63, dtype=int), 10)) == 10
