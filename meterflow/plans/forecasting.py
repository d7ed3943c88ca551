"""Forecasts from a trained :class:`Forecaster`: newest hours, and what-if rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models.regression import assemble, score
from ..operators.chunks import join_on
from ..operators.features import what_if_lags
from ..operators.metrics import PREDICTED
from ..operators.peaks import forecast_record, insight_table, what_if_table
from ..schema import BASE_COLUMNS
from .training import Forecaster


def predict(trained: Forecaster, rows: DataFrame) -> DataFrame:
    """Add the selected model's (or blend's) prediction to feature rows."""
    vectors = assemble(rows, trained.features, rows.columns)
    scored = score(trained.scoring_models(), vectors)
    return scored.select(*rows.columns, trained.prediction().alias(PREDICTED))


def predict_next_6_hours(trained: Forecaster) -> DataFrame:
    """One forecast row per series, from the features stored at training time."""
    tables = trained.tables
    return forecast_record(
        predict(trained, tables["latest_features"]),
        tables["thresholds"],
        tables["next_peak"],
        trained.series_cols,
    )


# The earlier name of the same forecast.
predict_next_hour = predict_next_6_hours


def insight(trained: Forecaster) -> DataFrame:
    return insight_table(predict_next_6_hours(trained), trained.best_model, trained.series_cols)


def predict_what_if(trained: Forecaster, scenarios: DataFrame) -> DataFrame:
    """Score scenarios: a table of assumed power, voltage and current values.

    A scenario takes every other feature from the newest row of its series and
    gets power lags that decay from the assumed power.
    """
    latest = trained.tables["latest_features"].drop(*BASE_COLUMNS)
    series = trained.series_cols
    if series:
        rows = join_on(scenarios, latest, series)
    else:
        newest = latest.select(F.struct("*").alias("row")).scalar()
        rows = scenarios.withColumn("_latest", newest).select(*scenarios.columns, "_latest.*")
    scored = predict(trained, what_if_lags(rows))
    shown = [*scenarios.columns, PREDICTED]
    return what_if_table(scored.select(*shown), trained.tables["thresholds"], series)
