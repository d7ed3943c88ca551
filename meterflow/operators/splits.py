"""Time-ordered splits: earlier rows train, later rows test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..schema import DAY, SPLIT_RATIO, VALIDATION_RATIO
from .chunks import LENGTH, POSITION, with_position

SPLIT = "split"
FIT = "fit"
VALIDATION = "validation"
TRAIN = "train"
TEST = "test"


def _share(rows: Column, ratio: float) -> Column:
    """Whole part of ``rows * ratio``, in the same double arithmetic everywhere."""
    return F.floor(rows.cast("double") * F.lit(float(ratio)))


def chrono_split(
    frame: DataFrame,
    series_cols: Sequence[str] = (),
    ratio: float = SPLIT_RATIO,
    validation_ratio: float = VALIDATION_RATIO,
) -> DataFrame:
    """Label every hourly row ``fit``, ``validation`` or ``test``.

    The first ``ratio`` of a series trains; the first ``validation_ratio`` of
    that is fitted and the rest validates.
    """
    train = _share(F.col(LENGTH), ratio)
    fit = _share(train, validation_ratio)
    label = (
        F.when(F.col(POSITION) < fit, FIT).when(F.col(POSITION) < train, VALIDATION).otherwise(TEST)
    )
    return with_position(frame, series_cols).withColumn(SPLIT, label).drop(POSITION, LENGTH)


def daily_split(
    days: DataFrame, series_cols: Sequence[str] = (), ratio: float = SPLIT_RATIO
) -> DataFrame:
    """Label every day ``train`` or ``test``. One row per day keeps the window small."""
    series = W.partitionBy(*series_cols)
    position = F.row_number().over(series.orderBy(DAY)) - 1
    train = _share(F.count(F.lit(1)).over(series), ratio)
    return days.withColumn(SPLIT, F.when(position < train, TRAIN).otherwise(TEST))
