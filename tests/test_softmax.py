"""Multiclass boosting against plain NumPy, and what it promises."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors

from meterflow.models.softmax import SoftmaxBoosting, SoftmaxEnsemble, _softmax

LABELS = [3, 7, 19]


def table(spark, x, y, parts=4):
    rows = [(Vectors.dense(a), int(b), k) for k, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, ["features", "hour", "row"]).repartition(parts)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(240, 4)), 2)
    x[:, 3] = 2.0  # a constant feature never splits
    place = np.where(x[:, 0] + x[:, 1] > 0.6, 2, np.where(x[:, 2] > 0, 1, 0))
    return x, np.array(LABELS)[place]


def softmax(f):
    e = np.exp(f - f.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def plain(x, y, model: SoftmaxBoosting):
    edges = [sorted({e for e in np.quantile(c, np.arange(1, model.bins) / model.bins) if e > c.min()}) for c in x.T]
    bins = np.stack([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T, strict=True)], axis=1)
    labels = sorted(set(y))
    hit = np.stack([y == label for label in labels], axis=1).astype(float)
    f = np.tile(np.log(hit.mean(axis=0)), (len(y), 1))
    for _ in range(model.rounds):
        p, step = softmax(f), np.zeros_like(f)
        for k in range(len(labels)):
            g, h = hit[:, k] - p[:, k], p[:, k] * (1 - p[:, k])
            nodes = [np.arange(len(y))]
            for _ in range(model.depth):
                found = []
                for own in nodes:
                    best = None
                    for j in range(x.shape[1]):
                        for cut in range(len(edges[j])):
                            sides = own[bins[own, j] <= cut], own[bins[own, j] > cut]
                            if min(map(len, sides)) < model.min_leaf:
                                continue
                            gain = sum(g[s].sum() ** 2 / len(s) for s in sides) - g[own].sum() ** 2 / len(own)
                            if gain > 1e-8 and (best is None or gain > best[0] + 1e-8):
                                best = gain, sides
                    if best:
                        for side in best[1]:
                            step[side, k] = model.step * (len(labels) - 1) / len(labels) * g[side].sum() / h[side].sum()
                            found.append(side)
                nodes = found
        f = f + step
    return softmax(f)


@pytest.mark.parametrize("more", [{}, {"depth": 1, "rounds": 6, "min_leaf": 1}])
def test_equals_plain_numpy(spark, data, more):
    x, y = data
    model = SoftmaxBoosting("hour", "chances", **{"rounds": 3, "step": 0.3, "depth": 2, "min_leaf": 10, "bins": 12, **more})
    rows = table(spark, x, y)
    fitted = model.fit(rows)
    found = np.array([r.chances for r in fitted.transform(rows).orderBy("row").collect()])
    assert fitted.labels == LABELS
    assert np.abs(found - plain(x, y, model)).max() < 1e-6
    assert np.abs(found.sum(axis=1) - 1).max() < 1e-12


def test_edges_come_from_all_rows_of_a_large_table(spark):
    x = np.random.default_rng(3).lognormal(sigma=2.0, size=(60_000, 2))
    y = np.array(LABELS)[np.searchsorted([0.4, 3.0], x[:, 0] * x[:, 1])]
    rows = spark.createDataFrame([(a, b, int(c), k) for k, ((a, b), c) in enumerate(zip(x.tolist(), y, strict=True))], "a double, b double, hour int, row int")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    model = SoftmaxBoosting("hour", "chances", rounds=2, step=0.3, depth=1, min_leaf=5, bins=8)
    found = np.array([r.chances for r in model.fit(rows).transform(rows).orderBy("row").collect()])
    assert np.abs(found - plain(x, y, model)).max() < 1e-6


def test_loss_falls_every_round_and_models_are_kept(spark, data, tmp_path):
    x, y = data
    rows = table(spark, x, y)
    fitted = SoftmaxBoosting("hour", "chances", rounds=6, step=0.3, depth=2).fit(rows)
    losses = []
    for n in range(7):
        part = SoftmaxEnsemble("chances", fitted.labels, fitted.base, fitted.depth, [own[:n] for own in fitted.trees])
        scored = part.transform(rows).collect()
        losses.append(-np.mean([np.log(r.chances[LABELS.index(r.hour)]) for r in scored]))
    assert all(later < earlier for earlier, later in zip(losses, losses[1:], strict=False))
    assert all(3 not in tree.feature for own in fitted.trees for tree in own)
    fitted.write().overwrite().save(f"{tmp_path}/model")
    assert SoftmaxEnsemble.load(f"{tmp_path}/model") == fitted


def test_partitions_and_rows_without_a_class(spark, data):
    x, y = data
    model = SoftmaxBoosting("hour", "chances", rounds=2, step=0.3, depth=3, bins=32)
    first = model.fit(table(spark, x, y, 1))
    more = table(spark, x, y, 7).selectExpr("features", "hour").unionByName(
        table(spark, x[:5], y[:5]).selectExpr("features", "CAST(NULL AS BIGINT) AS hour")
    )
    assert model.fit(more) == first
    with pytest.raises(ValueError):
        model.fit(table(spark, x, y).filter("hour = 3"))


def test_rows_of_equal_bins_and_class_are_one_row_with_their_number(spark, data, monkeypatch):
    x, y = np.repeat(data[0], 5, axis=0), np.repeat(data[1], 5)
    seen, grow = [], SoftmaxBoosting._round

    def spy(self, table, fresh):
        seen.append((table.count(), table.select("_x", "_y").distinct().count(), table.selectExpr("sum(_n)").first()[0]))
        return grow(self, table, fresh)

    monkeypatch.setattr(SoftmaxBoosting, "_round", spy)
    model = SoftmaxBoosting("hour", "chances", rounds=5, step=0.3, depth=2, min_leaf=10, bins=4)
    rows = table(spark, x, y)
    found = np.array([r.chances for r in model.fit(rows).transform(rows).orderBy("row").collect()])
    assert np.abs(found - plain(x, y, model)).max() < 1e-6
    assert len(seen) == 5 and len(set(seen)) == 1
    n, cells, counted = seen[0]
    assert n == cells <= 4 ** 3 * 3 and counted == len(y)


def test_chances_cost_as_many_steps_as_there_are_classes(spark):
    """Largest margin and total are computed once a row: once a class they took 67 s here."""
    margins = np.random.default_rng(5).normal(scale=300.0, size=(16, 600))
    rows = spark.createDataFrame([(k, m.tolist()) for k, m in enumerate(margins)], "row int, f array<double>").repartition(1)
    start = time.monotonic()
    found = np.array([r.p for r in rows.withColumn("p", _softmax("f")).orderBy("row").collect()])
    assert time.monotonic() - start < 20
    assert np.abs(found - softmax(margins)).max() < 1e-12
