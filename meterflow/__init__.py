"""Load forecasting on Spark: hourly tables, features, models, peaks, forecasts."""

from .plans.forecasting import insight, predict_next_6_hours, predict_next_hour, predict_what_if
from .plans.frames import build_daily_peak_frame, build_model_frame, preprocess_hourly
from .plans.jobs import forecast, load_or_train, run_training
from .plans.training import Forecaster, train_and_evaluate
from .sources.artifacts import load_artifacts, save_artifacts
from .sources.readings import read_readings as load_raw_data
from .sources.readings import recent_readings

__all__ = [
    "Forecaster",
    "build_daily_peak_frame",
    "build_model_frame",
    "forecast",
    "insight",
    "load_artifacts",
    "load_or_train",
    "load_raw_data",
    "predict_next_6_hours",
    "predict_next_hour",
    "predict_what_if",
    "preprocess_hourly",
    "recent_readings",
    "run_training",
    "save_artifacts",
    "train_and_evaluate",
]
