"""Peak periods, flags, lookups and newest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import hour_label
from ..schema import DATETIME, PEAK_QUANTILE, POWER
from .chunks import join_on
from .metrics import ACTUAL, PREDICTED

THRESHOLD = "peak_threshold"
# A quantile sketch errs by at most this part of the rows.
SKETCH = 10_000


def peak_threshold(
    comparison: DataFrame, series_cols: Sequence[str] = (), quantile: float = PEAK_QUANTILE
) -> DataFrame:
    """The interpolated quantile of the actual values, one row per series; null values do not count.

    A sketch per series gives two values that enclose the wanted rank for sure: it errs by at most
    1 / ``SKETCH`` of the rows, and the values are taken at shares further away than that. Rows below
    are counted, those between are counted by value, and running counts find the two neighbours
    of the rank. So no task holds a series' values, and less than a thousandth of a long series
    is ordered at all.
    """
    values = comparison.select(*series_cols, F.col(ACTUAL).alias("_v")).filter("_v IS NOT NULL")
    rows = F.col("_n")
    steps = [4.0**step * 4 / SKETCH for step in range(6)]
    low = [max(quantile - step, 0.0) for step in steps]
    high = [min(quantile + step, 1.0) for step in steps]
    sketch = values.groupBy(*series_cols).agg(
        F.percentile_approx("_v", [*low, *high], SKETCH).alias("_near"),
        F.count("_v").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"),
    )
    # The first step that is worth two rows more than the sketch's error.
    wide = [F.lit(step - 1 / SKETCH) * rows >= 2 for step in steps]
    sketch = sketch.select(
        *series_cols, "_n",
        F.coalesce(*(F.when(w, F.get("_near", F.lit(k))) for k, w in enumerate(wide)), "_least").alias("_low"),
        F.coalesce(
            *(F.when(w, F.get("_near", F.lit(len(steps) + k))) for k, w in enumerate(wide)), "_most"
        ).alias("_high"),
    )
    joined = join_on(values, sketch, series_cols) if series_cols else values.crossJoin(F.broadcast(sketch))
    inside = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))  # null for the rows below
    counted = joined.filter("_v <= _high").groupBy(*series_cols, "_n", inside.alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    ordered = W.partitionBy(*series_cols).orderBy(F.col("_value").asc_nulls_first())
    upto = counted.withColumn("_upto", F.sum("_rows").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    rank = (rows - 1) * F.lit(quantile)
    at = {"_lower": F.floor(rank), "_upper": F.ceil(rank)}  # counted from 0
    found = upto.groupBy(*series_cols, "_n").agg(
        *(F.min(F.when(F.col("_upto") > place, F.col("_value"))).alias(name) for name, place in at.items()),
        F.coalesce(F.max(F.when(F.col("_value").isNull(), F.col("_rows"))), F.lit(0)).alias("_below"),
    )
    enclosed = (F.col("_below") <= F.floor(rank)) & F.col("_upper").isNotNull()
    value = F.col("_lower") + (F.col("_upper") - F.col("_lower")) * (rank - F.floor(rank))
    checked = F.when(enclosed, value).otherwise(F.raise_error(F.lit("the sketch missed the quantile")).cast("double"))
    if series_cols:
        return found.select(*series_cols, checked.alias(THRESHOLD))
    # One row also where there are no values.
    return found.agg(F.max(checked).alias(THRESHOLD))


def with_threshold(
    rows: DataFrame, thresholds: DataFrame, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Attach each series' threshold; without series there is just one value."""
    if series_cols:
        return join_on(rows, thresholds, series_cols, "left")
    return rows.withColumn(THRESHOLD, thresholds.select(THRESHOLD).scalar())


def peak_periods(
    comparison: DataFrame, thresholds: DataFrame, series_cols: Sequence[str] = ()
) -> DataFrame:
    found = with_threshold(comparison, thresholds, series_cols)
    return found.filter(F.col(ACTUAL) >= F.col(THRESHOLD)).drop(THRESHOLD)


def peak_count(peaks: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    rows = F.count(F.lit(1))
    return peaks.groupBy(*series_cols).agg(rows.alias("peaks"), (rows == 0).alias("no_peaks"))


def first_rows(table: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    return table.orderBy(*order).limit(k)


def is_peak(value: Column) -> Column:
    return value >= F.col(THRESHOLD)


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").otherwise("No")


def lookup_error(
    comparison: DataFrame,
    thresholds: DataFrame,
    series_cols: Sequence[str] = (),
    at: str | None = None,
) -> DataFrame:
    """Actual, predicted, absolute error and peak flag of test hours.

    ``at`` picks one hour; text that is no timestamp picks nothing.
    """
    moment = F.col(DATETIME)
    rows = comparison.withColumn(DATETIME, moment.try_cast("timestamp_ntz"))
    rows = rows.na.drop(subset=[DATETIME])
    if at is not None:
        rows = rows.filter(moment == F.lit(at).try_cast("timestamp_ntz"))
    return with_threshold(rows, thresholds, series_cols).select(
        *series_cols,
        F.date_format(moment, "yyyy-MM-dd HH:mm").alias("label"),
        ACTUAL,
        PREDICTED,
        F.abs(F.col(ACTUAL) - F.col(PREDICTED)).alias("error"),
        yes_no(is_peak(F.col(ACTUAL))).alias("peak"),
    )


def latest_rows(table: DataFrame, series_cols: Sequence[str] = (), by: str = DATETIME) -> DataFrame:
    """The newest row of every series, found by partial aggregation."""
    names = [name for name in table.columns if name not in series_cols]
    newest = F.max_by(F.struct(*names), F.col(by)).alias("_row")
    return table.groupBy(*series_cols).agg(newest).select(*series_cols, "_row.*")


def forecast_record(
    scored: DataFrame,
    thresholds: DataFrame,
    next_peak: DataFrame,
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """The published forecast: one row per series.

    ``scored`` has the newest hour and its prediction, ``next_peak`` the voted
    peak hour (``peak_hour``) of the next day.
    """
    rows = with_threshold(scored, thresholds, series_cols)
    if series_cols:
        rows = join_on(rows, next_peak, series_cols, "left")
    else:
        rows = rows.withColumn("peak_hour", next_peak.select("peak_hour").scalar())
    return rows.select(
        *series_cols,
        F.date_format(DATETIME, "yyyy-MM-dd HH:mm:ss").alias("timestamp_of_latest_input"),
        F.col(PREDICTED).alias("predicted_next_6h_avg_power_kw"),
        is_peak(F.col(PREDICTED)).alias("is_predicted_peak_period"),
        F.col("peak_hour").cast("int").alias("predicted_peak_hour_next_day"),
        hour_label(F.col("peak_hour").cast("int")).alias("backup_power_time_window"),
    )


def insight_table(
    forecast: DataFrame, model: str, series_cols: Sequence[str] = ()
) -> DataFrame:
    """The operational summary shown to people."""
    hour = F.col("predicted_peak_hour_next_day")
    return forecast.select(
        *series_cols,
        F.col("timestamp_of_latest_input").alias("latest_timestamp"),
        F.lit(model).alias("best_model"),
        F.round("predicted_next_6h_avg_power_kw", 4).alias("predicted_next_6h_avg_power_kw"),
        yes_no(F.col("is_predicted_peak_period")).alias("predicted_peak"),
        hour.alias("predicted_peak_hour_next_day"),
        F.format_string("%02d:00", hour).alias("peak_hour_text"),
        "backup_power_time_window",
    )


def what_if_table(
    scored: DataFrame, thresholds: DataFrame, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Scored scenarios with the change against current power and the peak flag."""
    return with_threshold(scored, thresholds, series_cols).withColumns(
        {
            "delta": F.col(PREDICTED) - F.col(POWER),
            "predicted_peak": yes_no(is_peak(F.col(PREDICTED))),
        }
    ).drop(THRESHOLD)
