"""Registered queries against the same questions asked in SQL."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry

from .check import compare, database

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
FITTED = ("model_", "peak_hour_", "train_", "forecast_latest", "forecast_insight", "what_if_forecast", "daily_comparison")
SAMPLE = [
    "parse_timestamps", "coerce_numeric", "preprocess_hourly_by_user", "recent_rows",
    "model_frame", "model_frame_by_user", "compact_model_frame", "ewm_features",
    "daily_peak_frame", "chrono_split", "daily_split_by_user", "regression_metrics",
    "leaderboard", "stack_weights2", "peak_periods", "forecast_record", "what_if_features",
    "accuracy_weights", "weighted_vote", "standardize", "ridge_one_feature",
]


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, SQL[name]) is None


def test_every_query_without_a_model_has_sql():
    missing = {name for name in QUERIES if name not in SQL}
    # the numbered operators and their pipeline are tested by themselves
    missing = {name for name in missing if not re.match(r"op\d+_|pipeline$", name)}
    assert all(name.startswith(FITTED) for name in missing)
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = entry.entry(spark)
    assert len(frame.columns) == 65 and frame.count() > 0
