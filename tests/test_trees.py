"""Own tree ensembles against plain NumPy, and what they promise."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from meterflow.models import trees
from meterflow.models.trees import HistogramBoosting, RandomisedTrees, TreeEnsemble


def table(spark, x, y, parts=4):
    rows = [(Vectors.dense(a), float(b), k) for k, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, ["features", "actual", "row"]).repartition(parts)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(200, 4)), 2)
    x[:, 3] = 1.0  # a constant feature never splits
    return x, np.round(np.sin(2 * x[:, 0]) + x[:, 1] ** 2, 3)


def plain_boosting(x, y, model: HistogramBoosting):
    edges = [sorted({e for e in np.quantile(c, np.arange(1, model.bins) / model.bins) if e > c.min()}) for c in x.T]
    bins = np.stack([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T, strict=True)], axis=1)
    f = np.full(len(y), y.mean())

    def soft(g):
        return np.sign(g) * max(abs(g) - model.l1, 0.0)

    for number in range(model.trees):
        g, step = y - f, np.zeros(len(y))
        allowed = [k for k in model.drawn_columns(number, x.shape[1]) if edges[k]]
        nodes = [np.arange(len(y))]
        for _ in range(model.depth):
            found = []
            for own in nodes:
                best = None
                for k in allowed:
                    for cut in range(len(edges[k])):
                        left, right = own[bins[own, k] <= cut], own[bins[own, k] > cut]
                        if min(len(left), len(right)) < model.min_leaf:
                            continue
                        gain = sum(soft(g[s].sum()) ** 2 / (len(s) + model.l2) for s in (left, right))
                        gain -= soft(g[own].sum()) ** 2 / (len(own) + model.l2)
                        if gain > 1e-7 and (best is None or gain > best[0] + 1e-7):
                            best = gain, left, right
                if best:
                    for side in best[1:]:
                        step[side] = model.step * soft(g[side].sum()) / (len(side) + model.l2)
                        found.append(side)
            nodes = found
        f = f + step
    return f


@pytest.mark.parametrize("more", [
    {"l2": 0.1}, {"l1": 2.0, "l2": 1.5, "columns": 0.75}, {"depth": 1, "trees": 10, "l2": 1.0},
])
def test_boosting_equals_plain_numpy(spark, data, more):
    x, y = data
    model = HistogramBoosting("actual", "out", **{"trees": 3, "step": 0.3, "depth": 2, "min_leaf": 8, "bins": 16, **more})
    rows = table(spark, x, y)
    scored = model.fit(rows).transform(rows).orderBy("row").collect()
    assert np.abs(np.array([r.out for r in scored]) - plain_boosting(x, y, model)).max() < 1e-6


@pytest.mark.parametrize(("n", "bins"), [(1, 8), (2, 16), (900, 255), (60_000, 32)])
def test_edges_are_exact_quantiles_of_all_rows(spark, n, bins):
    rng = np.random.default_rng(n)
    x = np.stack([
        rng.lognormal(sigma=3.0, size=n), rng.integers(-2, 3, n).astype(float), np.where(rng.random(n) < 0.9, 7.0, rng.random(n)),
        np.full(n, 1.5), rng.normal(size=n) * 1e-300, np.where(rng.random(n) < 0.5, -0.0, rng.normal(size=n).round(2)),
    ], axis=1)
    rows = spark.createDataFrame([(a,) for a in x.tolist()], "v array<double>").repartition(5).select(array_to_vector("v").alias("features"))
    edges = trees.bin_edges(rows, bins)
    for found, values in zip(edges, x.T, strict=True):
        wanted = sorted({e for e in np.quantile(values, np.arange(1, bins) / bins) if e > values.min()})
        assert np.allclose(found, wanted, rtol=1e-12, atol=0)
    bins_of = [[int(np.searchsorted(e, v, "right")) for e, v in zip(edges, row, strict=True)] for row in x]
    placed = trees._binned(rows.withColumn("y", F.lit(0)), "y", edges, 0.0).select("_x").collect()
    assert sorted(list(r[0]) for r in placed) == sorted(bins_of)


def test_trees_do_not_depend_on_partitions(spark, data):
    x, y = data
    for model in (
        HistogramBoosting("actual", "out", trees=2, step=0.3, depth=3, rows=0.7, bins=32),
        RandomisedTrees("actual", "out", trees=3, depth=3, rows=0.8, columns=0.75),
    ):
        first, second = (model.fit(table(spark, x, y, parts)) for parts in (1, 7))
        assert first == second and len({str(t) for t in first.trees}) == len(first.trees)


def test_random_trees_learn_and_are_kept(spark, data, tmp_path):
    x, y = data
    rows = table(spark, x, y)
    model = RandomisedTrees("actual", "out", trees=8, depth=12).fit(rows)
    error = np.mean([(r.out - r.actual) ** 2 for r in model.transform(rows).collect()])
    assert error < 0.01 * y.var()  # leaves of one row, nearly
    assert all(3 not in tree.feature for tree in model.trees)
    model.write().overwrite().save(f"{tmp_path}/model")
    assert TreeEnsemble.load(f"{tmp_path}/model") == model


def test_a_penalty_shrinks_leaves(spark, data):
    x, y = data
    rows = table(spark, x, y)
    spread = []
    for l2 in (0.0, 100.0):
        model = HistogramBoosting("actual", "out", trees=1, step=1.0, depth=1, l2=l2).fit(rows)
        spread.append(max(map(abs, model.trees[0].value)))
    assert spread[1] < spread[0] / 1.5
    none = HistogramBoosting("actual", "out", trees=1, step=1.0, depth=2, l1=1e9).fit(rows)
    assert none.trees[0].feature == [trees.LEAF]


def test_labels_without_spread_and_without_rows(spark):
    rows = table(spark, np.arange(12.0).reshape(6, 2), np.full(6, 3.5))
    for model in (HistogramBoosting("actual", "out", 2, 0.1, 2), RandomisedTrees("actual", "out", 2, 2)):
        assert {r.out for r in model.fit(rows).transform(rows).collect()} == {3.5}
        with pytest.raises(ValueError):
            model.fit(rows.limit(0))
