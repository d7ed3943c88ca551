"""Classifiers of a day's peak hour, and the weighted vote over them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import IllegalArgumentException
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ensemble import vote_column
from ..schema import EPSILON, PEAK_HOUR, SEED
from .registry import BOOSTING, ModelSpec, full_depth
from .regression import VECTOR, fit_all
from .softmax import SoftmaxBoosting, SoftmaxEnsemble

HOURS = 24
VOTE = "predicted_peak_hour"
_CHANCES = "_chances"


@dataclass(frozen=True)
class PeakModel:
    """A fitted classifier. ``model`` is None where fitting failed.

    ``labels`` are the hours a boosted model numbers its classes by; a forest
    numbers them by the hour itself.
    """

    name: str
    model: Model | SoftmaxEnsemble | None
    labels: tuple[int, ...] = ()


def fit_peak_models(
    train: DataFrame, specs: list[ModelSpec], parallelism: int
) -> dict[str, PeakModel]:
    """Fit every classifier on rows of ``features`` and ``peak_hour``."""
    fits = [lambda spec=spec: _fit_or_none(train, spec) for spec in specs]
    return {fitted.name: fitted for fitted in fit_all(train.sparkSession, fits, parallelism)}


def _fit_or_none(train: DataFrame, spec: ModelSpec) -> PeakModel:
    try:
        if train.isEmpty():
            raise ValueError("no days to learn from")
        if spec.kind == BOOSTING:
            return _fit_boosting(train, spec)
        return PeakModel(spec.name, _forest(spec).fit(train))
    except (ValueError, RuntimeError, IllegalArgumentException):
        # Too little data for this model, or its fit gave up: it votes evenly and with no weight. What
        # Spark reports of lost executors, full memory and the like is none of these and is raised.
        return PeakModel(spec.name, None)


def _forest(spec: ModelSpec) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=PEAK_HOUR,
        numTrees=spec.trees,
        maxDepth=full_depth(spec),
        minInstancesPerNode=spec.min_leaf,
        bootstrap=spec.bootstrap,
        featureSubsetStrategy=spec.features,
        seed=SEED,
    )


def _fit_boosting(train: DataFrame, spec: ModelSpec) -> PeakModel:
    boosting = SoftmaxBoosting(
        PEAK_HOUR, _CHANCES, spec.trees, spec.step, full_depth(spec), spec.min_leaf, spec.bins
    )
    model = boosting.fit(train)
    return PeakModel(spec.name, model, tuple(model.labels))


def add_probabilities(models: Mapping[str, PeakModel], days: DataFrame) -> DataFrame:
    """An array of 24 probabilities per model and day."""
    for fitted in models.values():
        days = _add_probability(fitted, days)
    return days


def _add_probability(fitted: PeakModel, days: DataFrame) -> DataFrame:
    name = fitted.name
    if fitted.model is None:
        even = F.array_repeat(F.lit(1.0 / HOURS), HOURS)
        return days.withColumn(name, even)
    kept = days.columns
    scored = fitted.model.transform(days)
    if not fitted.labels:
        known = vector_to_array("probability")
        filled = F.concat(known, F.array_repeat(F.lit(0.0), HOURS))
        return scored.select(*kept, F.slice(filled, 1, HOURS).alias(name))
    place = {hour: index for index, hour in enumerate(fitted.labels)}
    chances = [
        F.get(_CHANCES, F.lit(place[hour])) if hour in place else F.lit(0.0) for hour in range(HOURS)
    ]
    return scored.select(*kept, F.array(*chances).alias(name))


def _best_hour(array: Column) -> Column:
    return F.array_position(array, F.array_max(array)) - 1


def peak_scores(models: Mapping[str, PeakModel], probabilities: DataFrame) -> dict[str, float]:
    """Accuracy of each model on labelled days; zero where fitting failed."""
    hits = [
        F.avg((_best_hour(F.col(name)) == F.col(PEAK_HOUR)).cast("double")).alias(name)
        for name in models
    ]
    row = probabilities.agg(*hits).first()
    return {
        name: float(row[name] or 0.0) if fitted.model is not None else 0.0
        for name, fitted in models.items()
    }


def vote_weights(scores: Mapping[str, float]) -> dict[str, float]:
    floored = {name: max(value, EPSILON) for name, value in scores.items()}
    total = sum(floored.values())
    return {name: value / total for name, value in floored.items()}


def add_vote(probabilities: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    arrays = {name: F.col(name) for name in weights}
    return probabilities.withColumn(VOTE, vote_column(arrays, weights, HOURS)).drop(*weights)
