"""Whole jobs: train from a file, load or train, and forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.metrics import observed, stage_counts
from ..schema import (
    COMPARISON_FILE,
    DATE,
    METRICS_FILE,
    NUMERIC_COLUMNS,
    PEAKS_FILE,
    SERVICE_MAX_ROWS,
    SERVICE_PROFILE,
    TIME,
)
from ..session import stage, stage_folder
from ..sources.artifacts import load_artifacts, save_artifacts
from ..sources.readings import read_readings, recent_readings
from ..sources.tables import write_csv
from .forecasting import predict_next_6_hours
from .frames import build_model_frame, preprocess_hourly
from .training import FRAME_TABLE, Forecaster, train_and_evaluate


def run_training(
    spark: SparkSession,
    data_path: str | None = None,
    profile: str = "balanced",
    max_rows: int | None = None,
    models_path: str = "models/power_forecast",
    reports_path: str = "reports",
    series_cols: Sequence[str] = (),
    full_budget: bool = False,
) -> Forecaster:
    """Read, clean, build features, train, write the reports and the artifact."""
    raw = recent_readings(read_readings(spark, data_path, series_cols), max_rows)
    trained = train_from_raw(raw, profile, series_cols, full_budget)
    write_reports(trained, reports_path)
    save_artifacts(models_path, trained)
    return trained


def train_from_raw(
    raw: DataFrame,
    profile: str = "balanced",
    series_cols: Sequence[str] = (),
    full_budget: bool = False,
) -> Forecaster:
    """The same from raw readings in memory, without files."""
    used = raw.select(*series_cols, DATE, TIME, *NUMERIC_COLUMNS)
    counted, seen = observed(used)
    trained = train_from_hourly(
        preprocess_hourly(counted, series_cols), profile, series_cols, full_budget
    )
    later = trained.tables["stage_counts"]
    if trained.tables["hourly"].isEmpty():  # nothing of the readings was left to observe
        first = stage_counts(raw=used)
    else:
        first = later.sparkSession.createDataFrame([("raw", seen.get["rows"])], later.schema)
    trained.tables["stage_counts"] = first.unionByName(later)
    return trained


def train_from_hourly(
    hourly: DataFrame,
    profile: str = "balanced",
    series_cols: Sequence[str] = (),
    full_budget: bool = False,
) -> Forecaster:
    folder = stage_folder(hourly.sparkSession)
    table = stage(hourly, folder, "hourly")
    frame = build_model_frame(table, series_cols=series_cols)
    trained = train_and_evaluate(
        frame, table, profile=profile, series_cols=series_cols, full_budget=full_budget,
        folder=folder,
    )
    trained.tables["hourly"] = table
    # Training has written the frame it was given; both tables' rows stand in the files' footers.
    model = hourly.sparkSession.read.schema(frame.schema).parquet(f"{folder}/{FRAME_TABLE}")
    trained.tables["stage_counts"] = stage_counts(hourly=table, model=model)
    return trained


def write_reports(trained: Forecaster, path: str) -> None:
    tables = trained.tables
    write_csv(tables["leaderboard"].orderBy("RMSE", "Model").coalesce(1), f"{path}/{METRICS_FILE}")
    write_csv(tables["comparison"], f"{path}/{COMPARISON_FILE}")
    write_csv(tables["peak_periods"], f"{path}/{PEAKS_FILE}")


def load_or_train(
    spark: SparkSession,
    models_path: str,
    data_path: str | None = None,
    profile: str = SERVICE_PROFILE,
    max_rows: int | None = SERVICE_MAX_ROWS,
    **options,
) -> Forecaster:
    """The stored forecaster, or a freshly trained one where none is stored."""
    try:
        return load_artifacts(spark, models_path)
    except FileNotFoundError:
        return run_training(spark, data_path, profile, max_rows, models_path, **options)


def forecast(spark: SparkSession, models_path: str, **options) -> DataFrame:
    return predict_next_6_hours(load_or_train(spark, models_path, **options))


def count_stages(raw: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Rows of the raw, hourly and model stages."""
    hourly = preprocess_hourly(raw, series_cols)
    frame = build_model_frame(hourly, series_cols=series_cols)
    return stage_counts(raw=raw, hourly=hourly, model=frame)
