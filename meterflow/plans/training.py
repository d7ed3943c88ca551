"""Training: split, fit, validate, stack, rank, find peaks, vote."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models.peak_hour import (
    VOTE,
    PeakModel,
    add_probabilities,
    add_vote,
    fit_peak_models,
    peak_scores,
    vote_weights,
)
from ..models.registry import classifiers, profile_name, regressors
from ..models.regression import assemble, estimator, fit_all, label_stats, score
from ..operators.ensemble import (
    as_mapping,
    blend_column,
    inverse_rmse_weights,
    stacked_weights,
    weighted_blend,
)
from ..operators.metrics import (
    ACTUAL,
    MODEL,
    PREDICTED,
    leaderboard,
    melt,
    regression_metrics,
    validation_rmse,
)
from ..operators.peaks import latest_rows, peak_periods, peak_threshold
from ..operators.splits import FIT, SPLIT, TEST, TRAIN, VALIDATION, chrono_split, daily_split
from ..schema import DATETIME, DAY, ENSEMBLE, PEAK_HOUR, SPLIT_RATIO, TARGET, TOP_MODELS
from ..session import stage, stage_folder
from .frames import build_daily_peak_frame

_PARALLEL_FITS = 8
# Fewer rows than this are not worth a task of their own in every tree level.
_ROWS_PER_TASK = 20_000
FRAME_TABLE = "model_frame"  # the written frame, in the folder of a training


@dataclass
class Forecaster:
    """What training leaves behind: tables, models and a few scalars."""

    profile: str
    series_cols: list[str]
    features: list[str]
    daily_features: list[str]
    best_model: str
    models: dict[str, Model]
    weights: dict[str, float]
    peak_models: dict[str, PeakModel]
    peak_weights: dict[str, float]
    peak_accuracy: float
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def prediction(self):
        """The column that scores rows the way the selected model does."""
        if self.best_model == ENSEMBLE:
            return blend_column(self.weights)
        return F.col(f"`{self.best_model}`")

    def scoring_models(self) -> dict[str, Model]:
        """Only the models the selected prediction needs."""
        if self.best_model == ENSEMBLE:
            return {name: self.models[name] for name, weight in self.weights.items() if weight}
        return {self.best_model: self.models[self.best_model]}


def train_and_evaluate(
    model_frame: DataFrame,
    hourly: DataFrame,
    split_ratio: float = SPLIT_RATIO,
    profile: str = "balanced",
    series_cols: Sequence[str] = (),
    full_budget: bool = False,
    compact_frame: bool = False,
    folder: str | None = None,
    parallelism: int = _PARALLEL_FITS,
) -> Forecaster:
    """Fit a profile's models on all series together and keep the best.

    Splits are by time within each series; the models learn from every series
    at once. Frames that several fits read are written to ``folder`` first.
    """
    series = list(series_cols)
    keys = [*series, DATETIME]
    folder = folder or stage_folder(model_frame.sparkSession)
    features = [name for name in model_frame.columns if name not in (*keys, TARGET)]

    frame = stage(model_frame, folder, FRAME_TABLE)
    split = stage(chrono_split(frame, series, split_ratio), folder, "split_frame")
    vectors = _training_vectors(split, features, keys).persist()
    try:
        models, trial_models = _fit_regressors(
            vectors, regressors(profile, full_budget, compact_frame), parallelism
        )
        names = list(models)
        trial = _scored(trial_models, vectors, VALIDATION, keys, folder, "validation_predictions")
        tested = _scored(models, vectors, TEST, keys, folder, "test_predictions")
    finally:
        vectors.unpersist()

    errors = as_errors(trial, names)
    weights = ensemble_weights(trial, errors, names, compact_frame)
    blended = weighted_blend(tested, weights)
    board = stage(
        leaderboard(regression_metrics(melt(blended, [*names, ENSEMBLE]))).coalesce(1),
        folder,
        "leaderboard",
    )
    best = board.orderBy("RMSE", MODEL).first()[MODEL]
    comparison = stage(
        blended.select(*keys, ACTUAL, F.col(f"`{best}`").alias(PREDICTED)), folder, "comparison"
    )
    thresholds = stage(peak_threshold(comparison, series), folder, "thresholds")
    peaks = stage(peak_periods(comparison, thresholds, series), folder, "peak_periods")

    daily = stage(build_daily_peak_frame(hourly, series, compact_frame), folder, "daily_frame")
    peak_models, peak_weights, peak_accuracy, daily_tables = _train_peak_hours(
        daily, series, split_ratio, classifiers(profile, full_budget, compact_frame),
        parallelism, folder,
    )
    return Forecaster(
        profile=profile_name(profile),
        series_cols=series,
        features=features,
        daily_features=[c for c in daily.columns if c not in (*series, DAY, PEAK_HOUR)],
        best_model=best,
        models=models,
        weights=weights,
        peak_models=peak_models,
        peak_weights=peak_weights,
        peak_accuracy=peak_accuracy,
        tables={
            "leaderboard": board,
            "validation_rmse": stage(errors, folder, "validation_rmse"),
            "comparison": comparison,
            "peak_periods": peaks,
            "thresholds": thresholds,
            "latest_features": stage(
                latest_rows(frame.drop(TARGET), series), folder, "latest_features"
            ),
            **daily_tables,
        },
    )


def _training_vectors(split: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Feature vectors in a fixed partitioning and order, so seeded fits repeat."""
    spark = split.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = min(most, split.count() // _ROWS_PER_TASK + 1)
    placed = split.repartition(partitions, *keys).sortWithinPartitions(*keys)
    return assemble(placed, features, [*keys, SPLIT, F.col(TARGET).alias(ACTUAL)])


def _fit_regressors(vectors: DataFrame, specs, parallelism: int):
    """Every spec fitted on all training rows, and again without the validation rows."""
    fit_rows = vectors.filter(F.col(SPLIT) == FIT)
    train_rows = vectors.filter(F.col(SPLIT) != TEST)
    fit_stats, train_stats = (label_stats(rows, ACTUAL) for rows in (fit_rows, train_rows))
    if fit_stats.rows == 0:
        raise ValueError("no complete rows to train on: the series are too short")
    trials = [
        partial(estimator(spec, ACTUAL, fit_stats).fit, fit_rows) for spec in specs
    ]
    finals = [
        partial(estimator(spec, ACTUAL, train_stats).fit, train_rows) for spec in specs
    ]
    fitted = fit_all(vectors.sparkSession, [*finals, *trials], parallelism)
    names = [spec.name for spec in specs]
    return (
        dict(zip(names, fitted[: len(names)], strict=True)),
        dict(zip(names, fitted[len(names) :], strict=True)),
    )


def _scored(models, vectors, part, keys, folder, table) -> DataFrame:
    rows = score(models, vectors.filter(F.col(SPLIT) == part))
    columns = [F.col(f"`{name}`") for name in models]
    return stage(rows.select(*keys, ACTUAL, *columns), folder, table)


def as_errors(trial: DataFrame, names: Sequence[str]) -> DataFrame:
    """Validation error per model, with the order the profile lists them in."""
    order = F.array_position(F.array(*[F.lit(name) for name in names]), F.col(MODEL))
    return validation_rmse(melt(trial, names)).withColumn("order", order)


def ensemble_weights(
    trial: DataFrame, errors: DataFrame, names: Sequence[str], every_model: bool = False
) -> dict[str, float]:
    """A weight per model: stacked over the best four, zero for the others.

    If stacking earns nothing, or for the older rule ``every_model``, weights
    follow the inverse validation error instead.
    """
    if every_model:
        return as_mapping(inverse_rmse_weights(errors))
    ranked = [row[MODEL] for row in errors.orderBy("rmse", "order").limit(TOP_MODELS).collect()]
    found = stacked_weights(trial, ranked)
    if found is None:
        found = as_mapping(inverse_rmse_weights(errors.filter(F.col(MODEL).isin(ranked))))
    return {name: found.get(name, 0.0) for name in names}


def _train_peak_hours(daily, series, split_ratio, specs, parallelism, folder):
    names = [c for c in daily.columns if c not in (*series, DAY, PEAK_HOUR)]
    days = assemble(
        daily_split(daily, series, split_ratio), names, [*series, DAY, SPLIT, PEAK_HOUR]
    ).persist()
    try:
        models = fit_peak_models(days.filter(F.col(SPLIT) == TRAIN), specs, parallelism)
        tested = add_probabilities(models, days.filter(F.col(SPLIT) == TEST))
        tested = stage(tested.drop("features", SPLIT), folder, "peak_probabilities")
        weights = vote_weights(peak_scores(models, tested))
        compared = stage(
            add_vote(tested, weights).select(
                *series, DAY, F.col(PEAK_HOUR).alias("actual_peak_hour"), VOTE
            ),
            folder,
            "daily_comparison",
        )
        newest = add_probabilities(models, latest_rows(days.drop(SPLIT), series, by=DAY))
        next_peak = stage(
            add_vote(newest, weights).select(*series, F.col(VOTE).alias(PEAK_HOUR)),
            folder,
            "next_peak",
        )
    finally:
        days.unpersist()
    hit = (F.col("actual_peak_hour") == F.col(VOTE)).cast("double")
    accuracy = compared.agg(F.avg(hit).alias("a")).first()["a"]
    tables = {"daily_frame": daily, "daily_comparison": compared, "next_peak": next_peak}
    return models, weights, float(accuracy or 0.0), tables
