"""Error metrics over predictions in long form, and small reports on them.

Long predictions have one row per model and hour: ``Model, actual, predicted``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schema import GOAL_ACCURACY, GOAL_RAE
from .chunks import join_on

MODEL = "Model"
ACTUAL = "actual"
PREDICTED = "predicted"
METRICS = ["MAE", "RMSE", "R2", "RAE", "Relative_Accuracy"]


def melt(wide: DataFrame, models: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One prediction column per model to one row per model."""
    columns = [F.col(f"`{name}`") for name in models]
    return wide.unpivot([*keys, ACTUAL], columns, MODEL, PREDICTED)


def regression_metrics(predictions: DataFrame, keys: Sequence[str] = (MODEL,)) -> DataFrame:
    """MAE, RMSE, R2, RAE and relative accuracy per group.

    The mean is known before deviations from it are summed: the one-pass form
    subtracts two large sums and loses the digits that matter.
    """
    means = predictions.groupBy(*keys).agg(F.avg(ACTUAL).alias("_mean"))
    if list(keys) == [MODEL]:
        # One row per model. Few models share all rows, so shuffling by model
        # would fill a few tasks; groups with series are left to the planner.
        means = F.broadcast(means)
    error = F.col(PREDICTED) - F.col(ACTUAL)
    deviation = F.col(ACTUAL) - F.col("_mean")
    sums = (
        join_on(predictions, means, keys)
        .groupBy(*keys)
        .agg(
            F.avg(F.abs(error)).alias("MAE"),
            F.sqrt(F.avg(error * error)).alias("RMSE"),
            F.sum(F.abs(error)).alias("_abs_error"),
            F.sum(error * error).alias("_sq_error"),
            F.sum(F.abs(deviation)).alias("_abs_dev"),
            F.sum(deviation * deviation).alias("_sq_dev"),
        )
    )
    flat = F.when(F.col("_sq_error") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = F.when(F.col("_sq_dev") == 0, flat).otherwise(
        F.lit(1.0) - F.try_divide(F.col("_sq_error"), F.col("_sq_dev"))
    )
    rae = F.when(F.col("_abs_dev") == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("_abs_error"), F.col("_abs_dev"))
    )
    return sums.select(
        *keys,
        "MAE",
        "RMSE",
        r2.alias("R2"),
        rae.alias("RAE"),
        (F.lit(1.0) - rae).alias("Relative_Accuracy"),
    )


def validation_rmse(predictions: DataFrame) -> DataFrame:
    error = F.col(PREDICTED) - F.col(ACTUAL)
    return predictions.groupBy(MODEL).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def accuracy(labels: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose two labels agree."""
    same = (F.col(actual) == F.col(predicted)).cast("double")
    return labels.groupBy(*keys).agg(F.avg(same).alias("accuracy"))


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models from best to worst error on the test rows; names break ties."""
    return metrics.select(MODEL, *METRICS).orderBy("RMSE", MODEL)


def best_model(board: DataFrame) -> DataFrame:
    return board.orderBy("RMSE", MODEL).limit(1)


def goal_gap(board: DataFrame) -> DataFrame:
    """How far the best model is from the goals."""
    return best_model(board).select(
        MODEL,
        "RAE",
        F.lit(GOAL_RAE).alias("goal_rae"),
        "Relative_Accuracy",
        F.lit(GOAL_ACCURACY).alias("goal_accuracy"),
        (F.lit(GOAL_ACCURACY) - F.col("Relative_Accuracy")).alias("gap"),
    )


def stage_counts(**stages: DataFrame) -> DataFrame:
    """One row per processing stage with its number of rows."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, frame in stages.items()
    ]
    table = counts[0]
    for other in counts[1:]:
        table = table.unionByName(other)
    return table


def observed(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """``frame`` and its number of ``rows``, known once a job has run over it without another scan.

    A report on a run: rows below a shuffle that were computed again after an executor was lost may
    count twice here, never in :func:`stage_counts`. Where nothing of the frame reaches the job's
    result, Spark drops the observation with that part of the plan.
    """
    seen = Observation()
    return frame.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def best_predictions(predictions: DataFrame, board: DataFrame) -> DataFrame:
    """The rows of the leaderboard's first model (one row, so it is broadcast)."""
    return predictions.join(F.broadcast(best_model(board).select(MODEL)), MODEL, "left_semi")
