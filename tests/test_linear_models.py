"""Linear models against their textbook solutions in NumPy."""

from __future__ import annotations

import numpy as np
import pytest

from meterflow.models.least_squares import LeastSquares, LinearModel
from meterflow.models.registry import ELASTIC_NET, OLS, RIDGE, ModelSpec
from meterflow.models.regression import assemble, estimator, label_stats

NAMES = ["a", "b", "c", "a_less_b", "flat"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) * [1.0, 5.0, 0.2] + [0.0, 30.0, -1.0]
    # A difference of two columns and a constant: both occur in model frames.
    x = np.column_stack([x, x[:, 0] - x[:, 1], np.full(200, 7.0)])
    y = x[:, 0] * 2 - x[:, 1] * 0.3 + rng.normal(size=200) * 0.5 + 4
    rows = [(*map(float, line), float(value)) for line, value in zip(x, y, strict=True)]
    schema = ", ".join(f"{name} double" for name in [*NAMES, "actual"])
    vectors = assemble(spark.createDataFrame(rows, schema).coalesce(1), NAMES, ["actual"])
    deviation = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(deviation == 0, 1, deviation)
    return vectors.cache(), z, y


def predictions(vectors, spec):
    model = estimator(spec, "actual", label_stats(vectors, "actual")).fit(vectors)
    return np.array([row[spec.name] for row in model.transform(vectors).collect()])


def test_ridge(data):
    vectors, z, y = data
    weights = np.linalg.solve(z.T @ z + np.eye(5), z.T @ (y - y.mean()))
    found = predictions(vectors, ModelSpec("Ridge", RIDGE, alpha=1.0))
    assert found == pytest.approx(z @ weights + y.mean(), abs=1e-8)


def test_least_squares_with_repeated_features(data):
    vectors, z, y = data
    weights = np.linalg.lstsq(z, y - y.mean(), rcond=None)[0]
    found = predictions(vectors, ModelSpec("Linear Regression", OLS))
    assert found == pytest.approx(z @ weights + y.mean(), abs=1e-9)


def test_least_norm_and_kept_models(spark, data, tmp_path):
    vectors, z, y = data
    model = LeastSquares("actual", "out").fit(vectors)
    deviation = np.array([np.std([row.features[k] for row in vectors.collect()]) for k in range(5)])
    weights = np.linalg.lstsq(z, y - y.mean(), rcond=None)[0]
    assert np.array(model.weights) * deviation == pytest.approx(weights, abs=1e-9)
    assert model.weights[4] == 0.0
    model.write().overwrite().save(f"{tmp_path}/model")
    assert LinearModel.load(f"{tmp_path}/model") == model
    with pytest.raises(ValueError):
        LeastSquares("actual", "out").fit(vectors.limit(1))


def test_elastic_net(data):
    vectors, z, y = data
    alpha, share = 0.4, 0.3
    weights, centred = np.zeros(5), y - y.mean()
    for _ in range(5000):
        for j in range(4):
            rest = centred - z @ weights + z[:, j] * weights[j]
            pull = z[:, j] @ rest / len(y)
            shrunk = np.sign(pull) * max(abs(pull) - alpha * share, 0.0)
            weights[j] = shrunk / (1.0 + alpha * (1.0 - share))
    found = predictions(vectors, ModelSpec("ElasticNet", ELASTIC_NET, alpha=alpha, l1_ratio=share))
    assert found == pytest.approx(z @ weights + y.mean(), abs=1e-4)
