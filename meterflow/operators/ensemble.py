"""Blending models: weights from validation errors, stacking, votes.

Weights are tables of ``Model, weight`` with one row per model. Predictions to
blend are wide, with one column per model, so blending needs no shuffle.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..schema import ENSEMBLE, EPSILON, TOP_MODELS
from .metrics import ACTUAL, MODEL


def _all_models():
    """Windows of this module order or total tables of one row per model."""
    return W.partitionBy()


def top_models(errors: DataFrame, k: int = TOP_MODELS, order: str = MODEL) -> DataFrame:
    """The ``k`` models with the least validation error; ``order`` breaks ties."""
    rank = F.row_number().over(_all_models().orderBy("rmse", order))
    return errors.withColumn("rank", rank).filter(F.col("rank") <= k)


def inverse_rmse_weights(errors: DataFrame) -> DataFrame:
    """Weights in proportion to one over the validation error."""
    inverse = F.lit(1.0) / F.greatest(F.col("rmse"), F.lit(EPSILON))
    return errors.select(MODEL, (inverse / F.sum(inverse).over(_all_models())).alias("weight"))


def accuracy_weights(scores: DataFrame) -> DataFrame:
    """Weights in proportion to accuracy; a model that never hits keeps a trace."""
    score = F.greatest(F.col("accuracy"), F.lit(EPSILON))
    return scores.select(MODEL, (score / F.sum(score).over(_all_models())).alias("weight"))


def pad_weights(models: DataFrame, weights: DataFrame) -> DataFrame:
    """A weight for every model: zero for those outside ``weights``."""
    return models.select(MODEL).join(weights, MODEL, "left").select(
        MODEL, F.coalesce("weight", F.lit(0.0)).alias("weight")
    )


def ranked_weights(weights: DataFrame) -> DataFrame:
    return weights.orderBy(F.desc("weight"), MODEL)


def stack_gram(wide: DataFrame, models: Sequence[str]) -> DataFrame:
    """Sums of products of every two models, and of each model with the actual.

    One row holds all that a least-squares fit needs: ``g_i_j`` and ``c_i``.
    """
    columns = [F.col(f"`{name}`") for name in models]
    pairs = itertools.combinations_with_replacement(range(len(models)), 2)
    products = [F.sum(columns[i] * columns[j]).alias(f"g_{i}_{j}") for i, j in pairs]
    crosses = [F.sum(column * F.col(ACTUAL)).alias(f"c_{i}") for i, column in enumerate(columns)]
    return wide.agg(*products, *crosses)


def non_negative_weights(gram: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """Least squares with coefficients of zero or more, for a handful of models.

    The answer has some set of positive coefficients and solves the plain least
    squares on that set. With four models there are 15 sets, so all are tried.
    """
    size = len(cross)
    best, best_loss = np.zeros(size), 0.0
    for count in range(1, size + 1):
        for chosen in itertools.combinations(range(size), count):
            part = list(chosen)
            inner, right = gram[np.ix_(part, part)], cross[part]
            found = np.linalg.lstsq(inner, right, rcond=None)[0]
            if (found < 0).any():
                continue
            loss = found @ inner @ found - 2 * found @ right
            if loss < best_loss:
                best_loss = loss
                best = np.zeros(size)
                best[part] = found
    return best


def stacked_weights(wide: DataFrame, models: Sequence[str]) -> dict[str, float] | None:
    """Stacking weights that sum to one, or None if no model earns any."""
    row = stack_gram(wide, models).first()
    size = len(models)
    gram = np.array([[row[f"g_{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)])
    weights = non_negative_weights(gram, np.array([row[f"c_{i}"] for i in range(size)]))
    total = float(weights.sum())
    if total <= 1e-12:
        return None
    return {name: float(weight / total) for name, weight in zip(models, weights, strict=True)}


def as_mapping(weights: DataFrame) -> dict[str, float]:
    """A weight table, one row per model, as a dictionary."""
    return {row[MODEL]: row["weight"] for row in weights.collect()}


def blend_column(weights: Mapping[str, float]) -> Column:
    """Weighted sum of the models' prediction columns."""
    terms = [F.col(f"`{name}`") * F.lit(weight) for name, weight in weights.items() if weight]
    total = F.lit(0.0)
    for term in terms:
        total = total + term
    return total


def weighted_blend(wide: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    return wide.withColumn(ENSEMBLE, blend_column(weights))


def weighted_vote(
    probabilities: DataFrame, weights: DataFrame, keys: Sequence[str], label: str = "label"
) -> DataFrame:
    """The label with the highest weighted probability; the smallest wins ties.

    ``probabilities`` has one row per key, model and label. A label a model
    does not know simply has no row and adds nothing. Weights are one row per
    model, so they are broadcast and no model becomes one task's work.
    """
    score = F.sum(F.col("weight") * F.col("probability"))
    return (
        probabilities.join(F.broadcast(weights), MODEL)
        .groupBy(*keys, label)
        .agg(score.alias("_score"))
        .groupBy(*keys)
        .agg(F.max_by(label, F.struct(F.col("_score"), -F.col(label))).alias(label))
    )


def vote_column(arrays: Mapping[str, Column], weights: Mapping[str, float], labels: int) -> Column:
    """The same vote over one probability array per model, index = label."""
    scores = []
    for label in range(labels):
        combined = F.lit(0.0)
        for name, array in arrays.items():
            combined = combined + F.lit(weights[name]) * F.get(array, F.lit(label))
        scores.append(combined)
    table = F.array(*scores)
    return (F.array_position(table, F.array_max(table)) - 1).cast("int")
