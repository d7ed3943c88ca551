"""Fixed names and settings shared by every module.

The column names, window lengths and thresholds below are fixed values: tables
written by this package keep the names users of the load-forecasting workflow
already query by.
"""

from __future__ import annotations

# Raw meter readings -------------------------------------------------------
DATE = "Date"
TIME = "Time"
NUMERIC_COLUMNS = [
    "Global_active_power",
    "Global_reactive_power",
    "Voltage",
    "Global_intensity",
    "Sub_metering_1",
    "Sub_metering_2",
    "Sub_metering_3",
]
RAW_COLUMNS = [DATE, TIME, *NUMERIC_COLUMNS]

# Hourly table -------------------------------------------------------------
DATETIME = "datetime"
POWER = "Global_active_power"
VOLTAGE = "Voltage"
CURRENT = "Global_intensity"
BASE_COLUMNS = [POWER, VOLTAGE, CURRENT]

# Model frame --------------------------------------------------------------
TARGET = "target_next_6h_avg"
HORIZON = 6
LAGS = [1, 2, 3, 6, 12, 24, 48]
ROLL_WINDOWS = [3, 6, 12, 24]
EWM_SPANS = [6, 24]

CALENDAR = ["hour", "day_of_week", "day_of_year", "month", "is_weekend"]
HOUR_CYCLE = ["hour_sin", "hour_cos"]
WEEKDAY_CYCLE = ["dow_sin", "dow_cos"]
LAG_FEATURES = [f"{name}_lag_{k}" for k in LAGS for name in ("power", "voltage", "current")]
ROLL_FEATURES = [
    f"{stat}_{k}"
    for k in ROLL_WINDOWS
    for stat in (
        "power_roll_mean",
        "power_roll_min",
        "power_roll_max",
        "power_roll_std",
        "current_roll_mean",
    )
]
DIFF_FEATURES = ["power_diff_1", "power_diff_24", "voltage_diff_1", "current_diff_1"]
PCT_FEATURES = ["power_pct_change_1", "current_pct_change_1"]
INTERACTIONS = ["voltage_x_current", "power_to_current_ratio"]
EWM_FEATURES = [f"power_ewm_{span}" for span in EWM_SPANS]

FEATURES = [
    *BASE_COLUMNS,
    *CALENDAR,
    *HOUR_CYCLE,
    *WEEKDAY_CYCLE,
    *LAG_FEATURES,
    *ROLL_FEATURES,
    *DIFF_FEATURES,
    *PCT_FEATURES,
    *INTERACTIONS,
    *EWM_FEATURES,
]

# The older, smaller feature set: no weekday cycle, rolling extremes,
# differences, ratios or exponentially weighted means.
COMPACT_ROLL_FEATURES = [
    f"{stat}_{k}"
    for k in ROLL_WINDOWS
    for stat in ("power_roll_mean", "power_roll_std", "current_roll_mean")
]
COMPACT_FEATURES = [
    *BASE_COLUMNS,
    *CALENDAR,
    *HOUR_CYCLE,
    *LAG_FEATURES,
    *COMPACT_ROLL_FEATURES,
]

# Daily peak frame ---------------------------------------------------------
DAY = "date"
PEAK_HOUR = "peak_hour"
DAILY_FEATURES = [
    "day_mean",
    "day_max",
    "day_std",
    "day_of_week",
    "month",
    "is_weekend",
    "prev_day_mean",
    "prev_day_max",
    "prev_day_std",
    "peak_hour_lag_1",
    "peak_hour_sin",
    "peak_hour_cos",
]
COMPACT_DAILY_FEATURES = DAILY_FEATURES[:9]

# Training and reporting ---------------------------------------------------
SPLIT_RATIO = 0.8
VALIDATION_RATIO = 0.8
TOP_MODELS = 4
PEAK_QUANTILE = 0.9
ENSEMBLE = "Weighted Ensemble"
SEED = 42
GOAL_RAE = 0.1
GOAL_ACCURACY = 0.9
EPSILON = 1e-8
WHAT_IF_DECAY = 0.95
SERVICE_PROFILE = "fast"
SERVICE_MAX_ROWS = 180_000
METRICS_FILE = "model_metrics"
COMPARISON_FILE = "test_comparison"
PEAKS_FILE = "peak_periods"
