from __future__ import annotations

import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from meterflow import (
    build_model_frame,
    forecast,
    insight,
    load_artifacts,
    load_or_train,
    load_raw_data,
    predict_next_6_hours,
    predict_what_if,
    preprocess_hourly,
    recent_readings,
    train_and_evaluate,
)
from meterflow.models import peak_hour
from meterflow.models.registry import classifiers, profile_name, regressors
from meterflow.plans import jobs
from meterflow.plans.jobs import count_stages
from meterflow.schema import BASE_COLUMNS, ENSEMBLE
from meterflow.session import stage
from meterflow.sources.tables import as_records, write_json

from .fixtures import minute_readings


def test_profiles():
    assert [len(regressors(p)) for p in ("fast", "balanced", "full")] == [7, 10, 10]
    assert [len(classifiers(p)) for p in (" Fast", "balanced", "full", "other")] == [2, 3, 3, 3]
    assert profile_name(" FULL ") == "full" and profile_name("unknown") == "balanced"
    assert max(spec.trees for spec in regressors("full", full_budget=True)) == 700
    assert [spec.name for spec in regressors("fast", compact_frame=True)] == [
        "Linear Regression", "Gradient Boosting",
    ]


def test_stage_counts(spark):
    counts = {r.stage: r.rows for r in count_stages(minute_readings(spark)).collect()}
    assert counts == {"raw": 64_800, "hourly": 1_080, "model": 1_031}


def test_a_job_counts_the_rows_it_works_on(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "raw")
    minute_readings(spark).write.parquet(path)
    plans = []

    def no_training(frame, hourly, folder, **_):
        stage(frame, folder, jobs.FRAME_TABLE)
        return SimpleNamespace(tables={})

    def written(df, folder, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, folder, name)

    monkeypatch.setattr(jobs, "train_and_evaluate", no_training)
    monkeypatch.setattr(jobs, "stage", written)
    raw = spark.read.parquet(path)
    got = {r.stage: r.rows for r in jobs.train_from_raw(raw).tables["stage_counts"].collect()}
    assert got == {r.stage: r.rows for r in count_stages(raw).collect()}
    assert plans[0].count("FileScan") == 1
    empty = jobs.train_from_raw(raw.limit(0)).tables["stage_counts"].collect()
    assert {r.stage: r.rows for r in empty} == {"raw": 0, "hourly": 0, "model": 0}


def test_leaderboard_beats_the_mean(trained):
    result, _ = trained
    rows = result.tables["leaderboard"].collect()
    assert {row.Model for row in rows} == {*result.models, ENSEMBLE}
    assert len(rows) == 8
    assert all(row.R2 > 0 for row in rows)
    assert all(row.Relative_Accuracy == pytest.approx(1 - row.RAE) for row in rows)
    assert result.best_model == min(rows, key=lambda r: (r.RMSE, r.Model)).Model


def test_ensemble_weights(trained):
    result, _ = trained
    assert set(result.weights) == set(result.models)
    assert sum(result.weights.values()) == pytest.approx(1.0)
    assert sum(1 for weight in result.weights.values() if weight > 0) <= 4


def test_table_sizes(trained):
    tables = trained[0].tables
    assert tables["comparison"].count() == 207
    assert tables["daily_frame"].count() == 44
    assert tables["daily_comparison"].count() == 9
    limit = tables["thresholds"].first()[0]
    high = tables["comparison"].filter(F.col("actual") >= limit)
    assert tables["peak_periods"].exceptAll(high).count() == 0
    assert tables["peak_periods"].count() == high.count() == 21
    assert 0.0 <= trained[0].peak_accuracy <= 1.0


def test_reports_and_records(spark, trained, tmp_path):
    result, folder = trained
    read = spark.read.option("header", True).csv
    board = read(f"{folder}/reports/model_metrics")
    assert board.columns == ["Model", "MAE", "RMSE", "R2", "RAE", "Relative_Accuracy"]
    assert board.first().Model == result.best_model
    assert read(f"{folder}/reports/test_comparison").count() == 207
    assert read(f"{folder}/reports/peak_periods").columns == ["datetime", "actual", "predicted"]
    records = as_records(result.tables["leaderboard"])
    assert len(records) == 8 and "RAE" in records[0]
    write_json(result.tables["leaderboard"], str(tmp_path / "board"))
    lines = [line for f in Path(tmp_path / "board").glob("part-*") for line in f.read_text().splitlines()]
    assert {json.loads(line)["Model"] for line in lines} == {r["Model"] for r in records}


def test_forecast_and_saved_artifacts(spark, trained):
    result, folder = trained
    mine = predict_next_6_hours(result).first()
    assert mine.timestamp_of_latest_input == "2024-02-14 22:00:00"
    assert isinstance(mine.is_predicted_peak_period, bool)
    hour = mine.predicted_peak_hour_next_day
    assert mine.backup_power_time_window == f"{hour:02d}:00 - {hour:02d}:59"
    stored = load_artifacts(spark, f"{folder}/models")
    assert stored.best_model == result.best_model and stored.weights == result.weights
    assert predict_next_6_hours(stored).first() == mine
    assert forecast(spark, f"{folder}/models").first() == mine
    shown = insight(stored).first()
    assert shown.predicted_next_6h_avg_power_kw == round(mine.predicted_next_6h_avg_power_kw, 4)
    assert shown.predicted_peak in ("Yes", "No") and shown.peak_hour_text == f"{hour:02d}:00"


def test_what_if_keeps_other_features(spark, trained):
    result, _ = trained
    latest = result.tables["latest_features"].first()
    values = [latest[name] for name in BASE_COLUMNS]
    names = ", ".join(f"{name} double" for name in BASE_COLUMNS)
    scenarios = spark.createDataFrame([(1, *values), (2, 0.5, 240.0, 2.0)], f"scenario int, {names}")
    rows = {row.scenario: row for row in predict_what_if(result, scenarios).collect()}
    assert set(rows) == {1, 2}
    assert rows[2].delta == pytest.approx(rows[2].predicted - 0.5)


def test_load_or_train_trains_on_a_miss(spark, trained, tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError):
        load_artifacts(spark, str(tmp_path / "none"))
    calls = []
    monkeypatch.setattr("meterflow.plans.jobs.run_training", lambda *a, **k: calls.append(a) or "new")
    assert load_or_train(spark, str(tmp_path / "none")) == "new"
    assert calls[0][2:4] == ("fast", 180_000)


def test_classifier_failure_votes_evenly(spark, trained, monkeypatch):
    def broken(*_):
        raise RuntimeError("cannot fit")

    monkeypatch.setattr(peak_hour, "_forest", broken)
    days = trained[0].tables["daily_frame"].select("peak_hour", "date")
    models = peak_hour.fit_peak_models(days, classifiers("fast"), 2)
    assert all(model.model is None for model in models.values())
    chances = peak_hour.add_probabilities(models, days)
    assert peak_hour.peak_scores(models, chances) == {"RandomForest": 0.0, "ExtraTrees": 0.0}
    voted = peak_hour.add_vote(chances, {"RandomForest": 0.5, "ExtraTrees": 0.5})
    assert {row.predicted_peak_hour for row in voted.collect()} == {0}


def test_recent_readings_and_repeatability(spark, trained):
    _, folder = trained
    raw = load_raw_data(spark, f"{folder}/readings")
    newest = recent_readings(raw, 10_000)
    assert newest.count() == 10_000
    frame = build_model_frame(preprocess_hourly(newest))
    again = build_model_frame(preprocess_hourly(recent_readings(raw, 10_000)))
    # 10,000 minutes touch 167 hours; 48 lead in and the last has no target.
    assert frame.count() == 167 - 49
    assert frame.exceptAll(again).count() == 0


def test_older_feature_set_blends_every_model(spark, trained):
    hourly = trained[0].tables["hourly"]
    frame = build_model_frame(hourly, compact=True)
    result = train_and_evaluate(frame, hourly, profile="fast", compact_frame=True)
    assert set(result.weights) == {"Linear Regression", "Gradient Boosting"}
    assert all(weight > 0 for weight in result.weights.values())
    assert list(result.peak_models) == ["RandomForest"]
    assert result.daily_features[-1] == "prev_day_std" and len(result.features) == 43
    assert all(row.R2 > 0 for row in result.tables["leaderboard"].collect())
    assert predict_next_6_hours(result).count() == 1
