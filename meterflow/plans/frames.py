"""The frames callers work with: hourly table, model frame, daily peak frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import known_rows
from ..operators.chunks import CHUNK_ROWS
from ..operators.daily import daily_peaks, with_previous_day
from ..operators.features import check_horizon, feature_frame
from ..operators.resample import hourly_mean, required_readings, type_readings
from ..schema import (
    COMPACT_DAILY_FEATURES,
    COMPACT_FEATURES,
    DAILY_FEATURES,
    DATETIME,
    DAY,
    DIFF_FEATURES,
    EWM_FEATURES,
    FEATURES,
    HORIZON,
    INTERACTIONS,
    LAGS,
    PCT_FEATURES,
    PEAK_HOUR,
    ROLL_WINDOWS,
    TARGET,
    VOLTAGE,
)


def preprocess_hourly(raw: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Raw reading text to the hourly table."""
    return hourly_mean(required_readings(type_readings(raw, series_cols)), series_cols)


def build_model_frame(
    hourly: DataFrame,
    forecast_horizon: int = HORIZON,
    series_cols: Sequence[str] = (),
    compact: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Features and target of every hour for which all of them are finite numbers."""
    check_horizon(forecast_horizon)
    names = [*(COMPACT_FEATURES if compact else FEATURES), TARGET]
    frame = feature_frame(hourly, series_cols, forecast_horizon, compact, chunk_rows)
    return frame.filter(_usable(compact)).select(*series_cols, DATETIME, *names)


# A row is complete if these are finite numbers; the other features then are too.
# Lags are NULL only at the start of a series, where the longest one is. A value
# in the last 24 rows shows in the longest rolling statistics, an older one only
# in its own lags; voltage has no rolling statistics, so all its lags count.
_DECIDING = [
    TARGET,
    VOLTAGE,
    *[f"voltage_lag_{k}" for k in LAGS],
    *[f"{name}_lag_{k}" for name in ("power", "current") for k in (24, 48)],
    "power_roll_mean_24",
    "power_roll_std_24",
    *[f"current_roll_mean_{k}" for k in ROLL_WINDOWS],
    *DIFF_FEATURES,
    *PCT_FEATURES,
    *INTERACTIONS,
    *EWM_FEATURES,
]
_COMPACT_DECIDING = ["power_roll_mean_24", "current_roll_mean_24"]


def _finite(names: Sequence[str]) -> str:
    """True if all columns are finite: times zero, anything else is NaN or NULL.

    One sum stays small enough for the JVM to compile; a comparison per column
    does not, and made this filter as slow as the windows below it.
    """
    return f"({' + '.join(f'{name} * 0D' for name in names)}) = 0D"


def _usable(compact: bool):
    if not compact:
        return F.expr(_finite(_DECIDING))
    # The smaller feature set keeps infinite readings, but no rolling statistic
    # of one: a full window counts finite values only.
    return F.expr(
        f"power_lag_48 IS NOT NULL AND {TARGET} IS NOT NULL AND NOT isnan({TARGET}) "
        f"AND {_finite(_COMPACT_DECIDING)}"
    )


def build_daily_peak_frame(
    hourly: DataFrame, series_cols: Sequence[str] = (), compact: bool = False
) -> DataFrame:
    """Per day: statistics, calendar, the previous day, and the hour of the peak."""
    names = COMPACT_DAILY_FEATURES if compact else DAILY_FEATURES
    frame = with_previous_day(daily_peaks(hourly, series_cols), series_cols)
    columns = [*names, PEAK_HOUR]
    return known_rows(frame, columns).select(*series_cols, DAY, *columns)
