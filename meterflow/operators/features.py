"""Time-series features of an hourly table.

Each family is a dictionary of SQL expressions over one chunk window, so any
number of families shares a single shuffle and sort (see :mod:`.chunks`).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_fields, known_rows
from ..schema import (
    BASE_COLUMNS,
    CURRENT,
    DATETIME,
    DIFF_FEATURES,
    EWM_FEATURES,
    EWM_SPANS,
    HORIZON,
    INTERACTIONS,
    LAG_FEATURES,
    LAGS,
    PCT_FEATURES,
    POWER,
    ROLL_FEATURES,
    ROLL_WINDOWS,
    TARGET,
    VOLTAGE,
    WHAT_IF_DECAY,
)
from .chunks import CHUNK, CHUNK_ROWS, LENGTH, POSITION, over_chunks

_SHORT = {"power": POWER, "voltage": VOLTAGE, "current": CURRENT}

# Weights below this share of the newest one no longer change a double.
_NEGLIGIBLE = 1e-17


def _decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


EWM_REACH = max(math.ceil(math.log(_NEGLIGIBLE) / math.log(_decay(s))) for s in EWM_SPANS)
LAG_REACH = max(LAGS)
ROLL_REACH = max(ROLL_WINDOWS) - 1


def target_column(window: str, horizon: int = HORIZON) -> dict[str, str]:
    """Mean power of the next rows: fewer near the end, none after the last row."""
    frame = f"{window} ROWS BETWEEN 1 FOLLOWING AND {horizon} FOLLOWING"
    return {TARGET: f"avg({POWER}) OVER ({frame})"}


def lag_columns(window: str) -> dict[str, str]:
    return {
        f"{name}_lag_{k}": f"lag({column}, {k}) OVER ({window})"
        for k in LAGS
        for name, column in _SHORT.items()
    }


def roll_columns(window: str) -> dict[str, str]:
    """Rolling statistics; NULL until a window is full."""
    statistics = {
        "power_roll_mean": f"avg({POWER})",
        "power_roll_min": f"min({POWER})",
        "power_roll_max": f"max({POWER})",
        "power_roll_std": f"stddev_samp({POWER})",
        "current_roll_mean": f"avg({CURRENT})",
    }
    return {
        f"{name}_{k}": f"CASE WHEN {POSITION} >= {k - 1} THEN {statistic} OVER "
        f"({window} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) END"
        for k in ROLL_WINDOWS
        for name, statistic in statistics.items()
    }


def diff_columns(window: str) -> dict[str, str]:
    steps = {
        "power_diff_1": (POWER, 1),
        "power_diff_24": (POWER, 24),
        "voltage_diff_1": (VOLTAGE, 1),
        "current_diff_1": (CURRENT, 1),
    }
    return {
        name: f"{column} - lag({column}, {k}) OVER ({window})"
        for name, (column, k) in steps.items()
    }


def pct_columns(window: str) -> dict[str, str]:
    """Relative change to the previous row; NULL after a zero."""
    steps = {"power_pct_change_1": POWER, "current_pct_change_1": CURRENT}
    return {
        name: f"try_divide({column}, lag({column}, 1) OVER ({window})) - 1D"
        for name, column in steps.items()
    }


def ewm_columns(window: str, chunk_rows: int = CHUNK_ROWS) -> dict[str, str]:
    """Exponentially weighted means of power, newest row first in weight.

    A row weighs ``decay**age``. Writing that as ``decay**-n`` of a rising row
    number ``n`` lets one running sum serve every row, since the common factor
    cancels between the weighted sum and the sum of weights. ``n`` restarts in
    each chunk, which keeps the weights far below the largest double; the chunk
    starts ``EWM_REACH`` rows early, beyond which weights are negligible.
    """
    running = f"OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    number = f"double({POSITION} - {CHUNK} * {chunk_rows} + {EWM_REACH})"
    known = f"abs({POWER}) < double('Infinity')"
    found = {}
    for span in EWM_SPANS:
        weight = f"CASE WHEN {known} THEN pow({1.0 / _decay(span)!r}D, {number}) END"
        value = f"CASE WHEN {known} THEN {POWER} * pow({1.0 / _decay(span)!r}D, {number}) END"
        found[f"power_ewm_{span}"] = (
            f"try_divide(sum({value}) {running}, sum({weight}) {running})"
        )
    return found


def interaction_columns() -> dict[str, Column]:
    return {
        "voltage_x_current": F.col(VOLTAGE) * F.col(CURRENT),
        "power_to_current_ratio": F.try_divide(F.col(POWER), F.col(CURRENT) + 1e-6),
    }


def _family(hourly, series_cols, names, columns, back, ahead=0) -> DataFrame:
    known = known_rows(hourly, BASE_COLUMNS)
    frame = over_chunks(known, columns, series_cols, back=back, ahead=ahead)
    return frame.select(*series_cols, DATETIME, *names)


def forward_target(
    hourly: DataFrame, series_cols: Sequence[str] = (), horizon: int = HORIZON
) -> DataFrame:
    check_horizon(horizon)
    return _family(
        hourly, series_cols, [POWER, TARGET],
        partial(target_column, horizon=horizon), back=0, ahead=horizon,
    )


def check_horizon(horizon: int) -> None:
    if horizon < 1:
        raise ValueError(f"the forecast horizon must be at least 1 row, not {horizon}")


def lag_features(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return _family(hourly, series_cols, LAG_FEATURES, lag_columns, back=LAG_REACH)


def rolling_features(
    hourly: DataFrame, series_cols: Sequence[str] = (), names: Sequence[str] = tuple(ROLL_FEATURES)
) -> DataFrame:
    return _family(hourly, series_cols, list(names), roll_columns, back=ROLL_REACH)


def diff_features(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return _family(hourly, series_cols, DIFF_FEATURES, diff_columns, back=24)


def pct_change_features(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return _family(hourly, series_cols, PCT_FEATURES, pct_columns, back=1)


def ewm_features(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return _family(hourly, series_cols, EWM_FEATURES, ewm_columns, back=EWM_REACH)


def calendar_features(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    fields = calendar_fields(F.col(DATETIME))
    return hourly.select(
        *series_cols, DATETIME, *[column.alias(name) for name, column in fields.items()]
    )


def interaction_features(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return hourly.withColumns(interaction_columns()).select(*series_cols, DATETIME, *INTERACTIONS)


def feature_frame(
    hourly: DataFrame, series_cols: Sequence[str], horizon: int, compact: bool, chunk_rows: int
) -> DataFrame:
    """Every feature and the target of every hourly row, complete or not."""

    def columns(window: str) -> dict[str, str]:
        found = target_column(window, horizon) | lag_columns(window) | roll_columns(window)
        if not compact:
            found |= diff_columns(window) | pct_columns(window) | ewm_columns(window, chunk_rows)
        return found

    frame = over_chunks(
        known_rows(hourly, BASE_COLUMNS),
        columns,
        series_cols,
        back=LAG_REACH if compact else EWM_REACH,
        ahead=horizon,
        chunk_rows=chunk_rows,
    )
    return frame.withColumns(
        {**calendar_fields(F.col(DATETIME)), **interaction_columns()}
    ).drop(POSITION, LENGTH)


def what_if_lags(features: DataFrame) -> DataFrame:
    """Power lags as if power had decayed towards the past; nothing else changes."""
    return features.withColumns(
        {f"power_lag_{k}": F.col(POWER) * F.lit(WHAT_IF_DECAY**k) for k in LAGS}
    )
