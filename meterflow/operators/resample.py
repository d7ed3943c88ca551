"""Raw readings to typed rows to one row per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_hour, hour_start, known_rows, reading_timestamp, to_number
from ..schema import BASE_COLUMNS, DATE, DATETIME, NUMERIC_COLUMNS, TIME


def type_readings(raw: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Parse the text columns of raw readings; bad values become NULL."""
    return raw.select(
        *series_cols,
        reading_timestamp(F.col(DATE), F.col(TIME)).alias(DATETIME),
        *[to_number(F.col(name)).alias(name) for name in NUMERIC_COLUMNS],
    )


def required_readings(typed: DataFrame) -> DataFrame:
    """Only readings with a time, a power, a voltage and a current."""
    return known_rows(typed, [DATETIME, *BASE_COLUMNS])


def hourly_mean(readings: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Mean power, voltage and current per hour; hours without readings are absent."""
    hours = readings.groupBy(
        *series_cols, epoch_hour(F.col(DATETIME)).alias("_hour")
    ).agg(*[F.avg(name).alias(name) for name in BASE_COLUMNS])
    # Opposite infinities average to NaN, which counts as missing.
    return known_rows(hours, BASE_COLUMNS).select(
        *series_cols, hour_start(F.col("_hour")).alias(DATETIME), *BASE_COLUMNS
    )
