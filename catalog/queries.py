"""Registered queries: name -> function of a session and a data folder.

Doubles are rounded to six decimals for the comparison with another engine.
The tiny shift before rounding moves exact halves off the edge, where the last
bit of a sum would decide.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions import hour_label
from meterflow.models.peak_hour import add_probabilities, add_vote, fit_peak_models
from meterflow.models.registry import (
    ELASTIC_NET,
    OLS,
    RIDGE,
    ModelSpec,
    classifiers,
    regressors,
)
from meterflow.models.regression import assemble, estimator, label_stats, standardize
from meterflow.operators import ensemble, features, metrics, peaks, splits
from meterflow.operators.daily import daily_peak_hour, daily_stats
from meterflow.operators.resample import required_readings, type_readings
from meterflow.plans.forecasting import insight, predict_next_6_hours, predict_what_if
from meterflow.models.softmax import SoftmaxBoosting
from meterflow.models.trees import HistogramBoosting, RandomisedTrees
from meterflow.plans.frames import build_daily_peak_frame, build_model_frame, preprocess_hourly
from meterflow.plans.jobs import count_stages, train_from_hourly
from meterflow.schema import (
    BASE_COLUMNS,
    COMPACT_FEATURES,
    CURRENT,
    DATETIME,
    DAY,
    ENSEMBLE,
    NUMERIC_COLUMNS,
    PEAK_HOUR,
    POWER,
    TARGET,
)
from meterflow.session import stage, stage_folder
from meterflow.sources.readings import recent_rows

from .inputs import (
    BY_TYPE,
    BY_USER,
    NAIVE,
    day_guesses,
    events,
    hour_probabilities,
    hourly,
    part,
    predictions,
    raw_text,
    readings,
)

Query = Callable[[SparkSession, str], DataFrame]

RECENT = 3000
NAMES = list(NAIVE)


def comparable(table: DataFrame) -> DataFrame:
    rounded = {
        name: F.round(F.col(f"`{name}`") + 1e-9, 6) + F.lit(0.0)
        for name, kind in table.dtypes
        if kind == "double"
    }
    return table.withColumns(rounded) if rounded else table


# Cleaning -----------------------------------------------------------------


def parse_timestamps(spark, sf):
    return type_readings(raw_text(spark, sf), ["event_id"]).select("event_id", DATETIME)


def coerce_numeric(spark, sf):
    return type_readings(raw_text(spark, sf), ["event_id"]).select("event_id", *NUMERIC_COLUMNS)


def required_rows(spark, sf):
    kept = required_readings(type_readings(raw_text(spark, sf), ["event_id"]))
    return kept.select("event_id", DATETIME, *BASE_COLUMNS)


def preprocess(spark, sf):
    return preprocess_hourly(raw_text(spark, sf))


def preprocess_by_user(spark, sf):
    return preprocess_hourly(raw_text(spark, sf), BY_USER)


def newest_rows(spark, sf):
    table = readings(spark, sf).select("event_id", DATETIME, POWER)
    return recent_rows(table, RECENT, F.col(DATETIME), ["event_id"])


def stage_rows(spark, sf):
    return count_stages(raw_text(spark, sf))


# Families of features, for the whole table or per user ----------------------


def on_hourly(operator, series=(), **options) -> Query:
    return lambda spark, sf: operator(hourly(spark, sf, series), series_cols=series, **options)


def rolled(column: str) -> list[str]:
    return [name for name in features.ROLL_FEATURES if name.startswith(column)]


# Predictions --------------------------------------------------------------


def tested_long(spark, sf):
    return metrics.melt(part(spark, sf, splits.TEST), NAMES)


def test_metrics(spark, sf):
    return metrics.regression_metrics(tested_long(spark, sf))


def metrics_by_user(spark, sf):
    wide = part(spark, sf, splits.TEST, BY_USER)
    long = metrics.melt(wide, NAMES, BY_USER)
    return metrics.regression_metrics(long, [*BY_USER, "Model"])


def errors(spark, sf):
    return metrics.validation_rmse(metrics.melt(part(spark, sf, splits.VALIDATION), NAMES))


def blended(spark, sf):
    """Test predictions with the blend of the four best on validation rows."""
    wide = predictions(spark, sf)
    held_out = wide.filter(F.col(splits.SPLIT) == splits.VALIDATION)
    rmse = metrics.validation_rmse(metrics.melt(held_out, NAMES))
    weights = ensemble.as_mapping(ensemble.inverse_rmse_weights(ensemble.top_models(rmse)))
    tested = wide.filter(F.col(splits.SPLIT) == splits.TEST).drop(splits.SPLIT)
    return ensemble.weighted_blend(tested, weights)


def blended_long(spark, sf):
    return metrics.melt(blended(spark, sf), [*NAMES, ENSEMBLE], [DATETIME])


def board(spark, sf):
    return metrics.leaderboard(metrics.regression_metrics(blended_long(spark, sf)))


def goal_gap(spark, sf):
    return metrics.goal_gap(board(spark, sf))


def best_predictions(spark, sf):
    long = blended_long(spark, sf)
    return metrics.best_predictions(
        long, metrics.leaderboard(metrics.regression_metrics(long))
    )


def weighted_blend(spark, sf):
    return blended(spark, sf).select(DATETIME, "actual", F.col(f"`{ENSEMBLE}`").alias("predicted"))


def top_models(spark, sf):
    return ensemble.top_models(errors(spark, sf))


def inverse_weights(spark, sf):
    return ensemble.inverse_rmse_weights(ensemble.top_models(errors(spark, sf)))


def inverse_weights_all(spark, sf):
    return ensemble.ranked_weights(ensemble.inverse_rmse_weights(errors(spark, sf)))


def padded_weights(spark, sf):
    rmse = errors(spark, sf)
    return ensemble.pad_weights(rmse, ensemble.inverse_rmse_weights(ensemble.top_models(rmse)))


def stack_gram(spark, sf):
    return ensemble.stack_gram(part(spark, sf, splits.VALIDATION), NAMES[:4])


def stack_weights2(spark, sf):
    pair = ["Last Hour", "Day Mean"]
    found = ensemble.stacked_weights(part(spark, sf, splits.VALIDATION), pair)
    return spark.createDataFrame(list(found.items()), "Model string, weight double")


# Peaks ---------------------------------------------------------------------


def comparison(spark, sf, series=()):
    return part(spark, sf, splits.TEST, series).select(
        *series, DATETIME, "actual", F.col("Last Hour").alias("predicted")
    )


def thresholds(spark, sf, series=()):
    return peaks.peak_threshold(comparison(spark, sf, series), series)


def peak_periods(spark, sf, series=()):
    rows = comparison(spark, sf, series)
    return peaks.peak_periods(rows, peaks.peak_threshold(rows, series), series)


def peak_count(spark, sf):
    return peaks.peak_count(peak_periods(spark, sf))


def first_peaks(spark, sf):
    return peaks.first_rows(peak_periods(spark, sf), [DATETIME], 50)


def lookup_error(spark, sf, series=()):
    rows = comparison(spark, sf, series)
    return peaks.lookup_error(rows, peaks.peak_threshold(rows, series), series)


def flag_peak(spark, sf):
    rows = comparison(spark, sf)
    flagged = peaks.with_threshold(rows, peaks.peak_threshold(rows))
    return flagged.select(DATETIME, "predicted", peaks.is_peak(F.col("predicted")).alias("is_peak"))


def backup_window(spark, sf):
    days = daily_peak_hour(hourly(spark, sf, BY_USER), BY_USER)
    return days.select(*BY_USER, DAY, hour_label(F.col(PEAK_HOUR)).alias("window"))


def forecast_rows(spark, sf):
    """Forecast records per user from a naive model: the last hour predicts."""
    table = hourly(spark, sf, BY_USER)
    rows = comparison(spark, sf, BY_USER)
    scored = peaks.latest_rows(rows.select(*BY_USER, DATETIME, "predicted"), BY_USER)
    newest_day = peaks.latest_rows(daily_peak_hour(table, BY_USER), BY_USER, by=DAY)
    return peaks.forecast_record(
        scored, peaks.peak_threshold(rows, BY_USER), newest_day.drop(DAY), BY_USER
    )


def insight_table(spark, sf):
    return peaks.insight_table(forecast_rows(spark, sf), "Last Hour", BY_USER)


def latest_features(spark, sf, series=()):
    frame = build_model_frame(hourly(spark, sf, series), series_cols=series)
    return peaks.latest_rows(frame.drop(TARGET), series)


def what_if_features(spark, sf):
    scenarios = readings(spark, sf).select("event_id", *BASE_COLUMNS)
    return features.what_if_lags(scenarios)


# Peak hours of days ----------------------------------------------------------


def guesses(spark, sf):
    days = build_daily_peak_frame(hourly(spark, sf, BY_USER), BY_USER)
    return day_guesses(spark, days)


def peak_accuracy(spark, sf):
    return metrics.accuracy(guesses(spark, sf), "actual", "predicted", ["Model"])


def accuracy_weights(spark, sf):
    return ensemble.accuracy_weights(peak_accuracy(spark, sf))


def weighted_vote(spark, sf):
    chances = hour_probabilities(spark, sf)
    scores = chances.groupBy("Model").agg(F.avg("probability").alias("accuracy"))
    return ensemble.weighted_vote(chances, ensemble.accuracy_weights(scores), BY_USER)


def daily_split(spark, sf, series=()):
    days = build_daily_peak_frame(hourly(spark, sf, series), series)
    return splits.daily_split(days, series).select(*series, DAY, PEAK_HOUR, splits.SPLIT)


def chrono_split(spark, sf, series=()):
    frame = build_model_frame(hourly(spark, sf, series), series_cols=series, compact=True)
    return splits.chrono_split(frame, series).select(*series, DATETIME, TARGET, splits.SPLIT)


# Models ----------------------------------------------------------------------


def split_frame(spark, sf):
    folder = stage_folder(spark)
    frame = stage(build_model_frame(hourly(spark, sf)), folder, "frame")
    return stage(splits.chrono_split(frame), folder, "split")


def scaled(spark, sf):
    frame = build_model_frame(hourly(spark, sf), compact=True)
    return standardize(frame, COMPACT_FEATURES).select(DATETIME, *COMPACT_FEATURES)


def regress(spark, sf, spec: ModelSpec, names=None):
    """Fit one model on the training hours and predict the test hours."""
    table = split_frame(spark, sf)
    outside = (DATETIME, TARGET, splits.SPLIT)
    names = names or [name for name in table.columns if name not in outside]
    vectors = assemble(table, names, [DATETIME, splits.SPLIT, F.col(TARGET).alias("actual")])
    train = vectors.filter(F.col(splits.SPLIT) != splits.TEST)
    model = estimator(spec, "actual", label_stats(train, "actual")).fit(train)
    scored = model.transform(vectors.filter(F.col(splits.SPLIT) == splits.TEST))
    return scored.select(DATETIME, "actual", F.col(f"`{spec.name}`").alias("predicted"))


ONE_FEATURE = {
    "ols_one_feature": ModelSpec("ols", OLS),
    "ridge_one_feature": ModelSpec("ridge", RIDGE, alpha=1.0),
    "elastic_net_one_feature": ModelSpec("net", ELASTIC_NET, alpha=0.5, l1_ratio=0.2),
}


# Features that repeat each other: a copy of one, and the difference of two.
REPEATED = [POWER, "power_lag_1", "power_diff_1", POWER]

TREE_FEATURES = [POWER, "hour", "power_lag_24", "power_roll_mean_6"]


def shallow_trees(spark, sf, model):
    """Trees of two levels on rounded features, so that SQL can grow the same ones."""
    rounded = [F.round(F.col(name) + 1e-9, 6).alias(name) for name in (*TREE_FEATURES, TARGET)]
    table = split_frame(spark, sf).select(DATETIME, splits.SPLIT, *rounded)
    vectors = assemble(table, TREE_FEATURES, [DATETIME, splits.SPLIT, F.col(TARGET).alias("actual")])
    fitted = model.fit(vectors.filter(F.col(splits.SPLIT) != splits.TEST))
    scored = fitted.transform(vectors.filter(F.col(splits.SPLIT) == splits.TEST))
    return scored.select(DATETIME, "actual", "predicted")


SHALLOW = {
    "boosted_trees_depth2": HistogramBoosting("actual", "predicted", trees=2, step=0.5, depth=2, min_leaf=5, bins=8, l1=0.5, l2=0.1),
    "boosted_stumps": HistogramBoosting("actual", "predicted", trees=3, step=0.5, depth=1, min_leaf=5, bins=16, l2=0.1),
    "random_tree_depth2": RandomisedTrees("actual", "predicted", trees=1, depth=2),
    "random_trees_depth1": RandomisedTrees("actual", "predicted", trees=3, depth=1, min_leaf=5),
}


def classify(spark, sf, spec: ModelSpec):
    days = splits.daily_split(build_daily_peak_frame(hourly(spark, sf, BY_TYPE), BY_TYPE), BY_TYPE)
    names = [c for c in days.columns if c not in (*BY_TYPE, DAY, PEAK_HOUR, splits.SPLIT)]
    vectors = assemble(
        stage(days, stage_folder(spark), "days"), names, [*BY_TYPE, DAY, splits.SPLIT, PEAK_HOUR]
    )
    models = fit_peak_models(vectors.filter(F.col(splits.SPLIT) == splits.TRAIN), [spec], 8)
    tested = add_probabilities(models, vectors.filter(F.col(splits.SPLIT) == splits.TEST))
    voted = add_vote(tested, {spec.name: 1.0})
    return voted.select(*BY_TYPE, DAY, PEAK_HOUR, "predicted_peak_hour")


DAY_FEATURES = ["day_mean", "day_max", "prev_day_max", "is_weekend"]
STUMPS = SoftmaxBoosting(PEAK_HOUR, "chances", rounds=3, step=0.3, depth=1, min_leaf=5, bins=8)


def softmax_stumps(spark, sf):
    """The chance that boosted stumps give to each test day's true peak hour, and their highest chance."""
    days = splits.daily_split(build_daily_peak_frame(hourly(spark, sf, BY_USER), BY_USER), BY_USER)
    rounded = [F.round(F.col(name) + 1e-9, 6).alias(name) for name in DAY_FEATURES]
    table = stage(days.select(*BY_USER, DAY, splits.SPLIT, PEAK_HOUR, *rounded), stage_folder(spark), "days")
    vectors = assemble(table, DAY_FEATURES, [*BY_USER, DAY, splits.SPLIT, PEAK_HOUR])
    fitted = STUMPS.fit(vectors.filter(F.col(splits.SPLIT) == splits.TRAIN))
    scored = fitted.transform(vectors.filter(F.col(splits.SPLIT) == splits.TEST))
    place = F.array_position(F.array(*map(F.lit, fitted.labels)), F.col(PEAK_HOUR).cast("int")) - 1
    true = F.coalesce(F.get("chances", place), F.lit(0.0))  # an hour that no training day has
    return scored.select(*BY_USER, DAY, true.alias("true_chance"), F.array_max("chances").alias("highest_chance"))


def trained(spark, sf):
    return train_from_hourly(hourly(spark, sf), "fast")


def train_leaderboard(spark, sf):
    return trained(spark, sf).tables["leaderboard"]


def daily_comparison(spark, sf):
    return train_from_hourly(hourly(spark, sf, BY_TYPE), "fast", BY_TYPE).tables[
        "daily_comparison"
    ]


def forecast_latest(spark, sf):
    return predict_next_6_hours(train_from_hourly(hourly(spark, sf, BY_TYPE), "fast", BY_TYPE))


def forecast_insight(spark, sf):
    return insight(trained(spark, sf))


def what_if_forecast(spark, sf):
    scenarios = readings(spark, sf).select("event_id", *BASE_COLUMNS)
    return predict_what_if(trained(spark, sf), scenarios)


def _slug(name: str) -> str:
    return name.lower().replace(" ", "_")


def build() -> dict[str, Query]:
    exact: dict[str, Query] = {
        "hourly_mean": hourly,
        "parse_timestamps": parse_timestamps,
        "coerce_numeric": coerce_numeric,
        "required_rows": required_rows,
        "preprocess_hourly": preprocess,
        "preprocess_hourly_by_user": preprocess_by_user,
        "recent_rows": newest_rows,
        "stage_counts": stage_rows,
        "regression_metrics": test_metrics,
        "regression_metrics_by_user": metrics_by_user,
        "validation_rmse": errors,
        "leaderboard": board,
        "goal_gap": goal_gap,
        "best_predictions": best_predictions,
        "weighted_blend": weighted_blend,
        "top_models": top_models,
        "inverse_rmse_weights": inverse_weights,
        "inverse_rmse_weights_all": inverse_weights_all,
        "padded_weights": padded_weights,
        "stack_gram": stack_gram,
        "stack_weights2": stack_weights2,
        "peak_count": peak_count,
        "first_peaks": first_peaks,
        "flag_peak": flag_peak,
        "backup_window": backup_window,
        "forecast_record": forecast_rows,
        "insight_table": insight_table,
        "what_if_features": what_if_features,
        "peak_accuracy": peak_accuracy,
        "accuracy_weights": accuracy_weights,
        "weighted_vote": weighted_vote,
        "standardize": scaled,
    }
    for suffix, series in (("", ()), ("_by_user", BY_USER)):
        families = {
            "forward_target": on_hourly(features.forward_target, series),
            "lag_features": on_hourly(features.lag_features, series),
            "rolling_power": on_hourly(
                features.rolling_features, series, names=rolled("power_roll")
            ),
            "rolling_current": on_hourly(
                features.rolling_features, series, names=rolled("current_roll")
            ),
            "diff_features": on_hourly(features.diff_features, series),
            "pct_change_features": on_hourly(features.pct_change_features, series),
            "ewm_features": on_hourly(features.ewm_features, series),
            "calendar_features": on_hourly(features.calendar_features, series),
            "interaction_features": on_hourly(features.interaction_features, series),
            "model_frame": on_hourly(build_model_frame, series),
            "compact_model_frame": on_hourly(build_model_frame, series, compact=True),
            "daily_stats": on_hourly(daily_stats, series),
            "daily_peak_hour": on_hourly(daily_peak_hour, series),
            "daily_peak_frame": on_hourly(build_daily_peak_frame, series),
            "compact_daily_frame": on_hourly(build_daily_peak_frame, series, compact=True),
            "chrono_split": partial(chrono_split, series=series),
            "daily_split": partial(daily_split, series=series),
            "peak_threshold": partial(thresholds, series=series),
            "peak_periods": partial(peak_periods, series=series),
            "lookup_error": partial(lookup_error, series=series),
            "latest_features": partial(latest_features, series=series),
        }
        exact |= {f"{name}{suffix}": query for name, query in families.items()}
    exact["hourly_mean_by_user"] = partial(hourly, series=BY_USER)
    exact |= {
        name: partial(regress, spec=spec, names=[POWER]) for name, spec in ONE_FEATURE.items()
    }
    exact |= {name: partial(shallow_trees, model=model) for name, model in SHALLOW.items()}
    exact["softmax_stumps"] = softmax_stumps
    exact["ols_repeated_features"] = partial(regress, spec=ONE_FEATURE["ols_one_feature"], names=REPEATED)
    fitted: dict[str, Query] = {
        f"model_{_slug(spec.name)}": partial(regress, spec=spec) for spec in regressors("balanced")
    }
    fitted |= {
        f"peak_hour_{_slug(spec.name)}": partial(classify, spec=spec)
        for spec in classifiers("balanced")
    }
    fitted |= {
        "train_leaderboard": train_leaderboard,
        "daily_comparison": daily_comparison,
        "forecast_latest": forecast_latest,
        "forecast_insight": forecast_insight,
        "what_if_forecast": what_if_forecast,
    }
    return {name: _comparable(query) for name, query in (exact | fitted).items()}


def _comparable(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(spark, sf_dir))
