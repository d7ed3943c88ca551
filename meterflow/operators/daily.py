"""Daily statistics and the hour of each day's highest power."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import cycle, weekday_index
from ..schema import DATETIME, DAY, PEAK_HOUR, POWER


def daily_stats(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return _by_day(hourly, series_cols).agg(*_statistics())


def daily_peak_hour(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return _by_day(hourly, series_cols).agg(_peak_hour())


def daily_peaks(hourly: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Statistics and peak hour together, in one aggregation."""
    return _by_day(hourly, series_cols).agg(*_statistics(), _peak_hour())


def _by_day(hourly, series_cols):
    return hourly.groupBy(*series_cols, F.col(DATETIME).cast("date").alias(DAY))


def _statistics():
    return [
        F.avg(POWER).alias("day_mean"),
        F.max(POWER).alias("day_max"),
        # One reading has no sample deviation: NULL, so the day drops out later.
        F.stddev_samp(POWER).alias("day_std"),
    ]


def _peak_hour():
    # The earliest hour wins a tie, whatever order the rows arrive in.
    hour = F.hour(DATETIME)
    return F.max_by(hour, F.struct(F.col(POWER), -hour)).alias(PEAK_HOUR)


def with_previous_day(days: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Calendar fields, the preceding day's values and the peak hour's cycle.

    "Preceding" is the preceding row. The window holds one row per day, some
    36,500 in a century, so a series stays small enough for one task.
    """
    window = W.partitionBy(*series_cols).orderBy(DAY)
    day = F.col(DAY)
    peak_sin, peak_cos = cycle(F.col(PEAK_HOUR), 24)
    return days.withColumns(
        {
            "day_of_week": weekday_index(day),
            "month": F.month(day),
            "is_weekend": (weekday_index(day) >= 5).cast("int"),
            "prev_day_mean": F.lag("day_mean").over(window),
            "prev_day_max": F.lag("day_max").over(window),
            "prev_day_std": F.lag("day_std").over(window),
            "peak_hour_lag_1": F.lag(PEAK_HOUR).over(window).cast("double"),
            "peak_hour_sin": peak_sin,
            "peak_hour_cos": peak_cos,
        }
    )
