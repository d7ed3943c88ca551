"""The driver's ``events`` table read as meter readings, and tables built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.resample import hourly_mean, required_readings
from meterflow.operators.splits import SPLIT, chrono_split
from meterflow.plans.frames import build_model_frame
from meterflow.schema import CURRENT, DATETIME, POWER, TARGET, VOLTAGE
from meterflow.session import stage, stage_folder

BY_USER = ["user_id"]
BY_TYPE = ["event_type"]

# Naive forecasts that stand in for fitted models where values must be exact.
NAIVE = {
    "Last Hour": POWER,
    "Yesterday": "power_lag_24",
    "Two Days Ago": "power_lag_48",
    "Half Day Mean": "power_roll_mean_12",
    "Day Mean": "power_roll_mean_24",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power is the event's value, voltage its ``k``, current a mix of both."""
    k = F.get_json_object("props", "$.k").cast("double")
    return events(spark, sf_dir).select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").alias(DATETIME),
        F.col("value").alias(POWER),
        k.alias(VOLTAGE),
        (F.col("value") * 4.2 + k * 0.1).alias(CURRENT),
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as the text of a meter export, with its usual faults.

    Error events have no power, ``k`` = 99 has an impossible time, ``k`` = 0 no
    voltage, and view events a sub-meter value with a unit in it.
    """
    k = F.get_json_object("props", "$.k")
    fault = F.col("event_type") == "error"
    return events(spark, sf_dir).select(
        "event_id",
        "user_id",
        F.date_format("ts", "d/M/yyyy").alias("Date"),
        F.when(k == "99", F.lit("25:61:00"))
        .otherwise(F.date_format("ts", "HH:mm:ss"))
        .alias("Time"),
        F.when(fault, F.lit("?")).otherwise(F.col("value").cast("string")).alias(POWER),
        k.alias("Global_reactive_power"),
        F.when(k == "0", F.lit("NaN")).otherwise(k).alias(VOLTAGE),
        F.col("value").cast("string").alias(CURRENT),
        F.when(F.col("event_type") == "view", F.concat(k, F.lit("d")))
        .otherwise(k)
        .alias("Sub_metering_1"),
        F.concat(F.lit(" "), k, F.lit(".5e1 ")).alias("Sub_metering_2"),
        F.concat(F.lit("-."), k).alias("Sub_metering_3"),
    )


def hourly(spark: SparkSession, sf_dir: str, series: Sequence[str] = ()) -> DataFrame:
    return hourly_mean(required_readings(readings(spark, sf_dir)), series)


def predictions(spark: SparkSession, sf_dir: str, series: Sequence[str] = ()) -> DataFrame:
    """Wide predictions of the naive models on split hours, written once.

    A query reads them several times, so they are staged as training does.
    """
    folder = stage_folder(spark)
    frame = build_model_frame(hourly(spark, sf_dir, series), series_cols=series, compact=True)
    columns = [F.col(column).alias(name) for name, column in NAIVE.items()]
    table = frame.select(*series, DATETIME, F.col(TARGET).alias("actual"), *columns)
    staged = stage(table, folder, "naive")
    return stage(chrono_split(staged, series), folder, "naive_split")


def part(spark: SparkSession, sf_dir: str, name: str, series: Sequence[str] = ()) -> DataFrame:
    return predictions(spark, sf_dir, series).filter(F.col(SPLIT) == name).drop(SPLIT)


def day_guesses(spark: SparkSession, days: DataFrame) -> DataFrame:
    """Long guesses of each day's peak hour: ``Model, actual, predicted``."""
    guesses = {
        "Yesterday": F.col("peak_hour_lag_1").cast("int"),
        "Weekday": F.col("day_of_week") * 3,
        "Evening": F.lit(19),
    }
    return days.withColumns(guesses).unpivot(
        ["user_id", "date", F.col("peak_hour").alias("actual")],
        list(guesses),
        "Model",
        "predicted",
    )


def hour_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models' chance of each hour per user: share of readings, share of power."""
    by_hour = (
        readings(spark, sf_dir)
        .groupBy("user_id", F.hour(DATETIME).alias("label"))
        .agg(F.count(F.lit(1)).cast("double").alias("Count"), F.sum(POWER).alias("Power"))
    )
    totals = by_hour.groupBy("user_id").agg(
        F.sum("Count").alias("_count"), F.sum("Power").alias("_power")
    )
    return (
        by_hour.join(totals, "user_id")
        .select(
            "user_id",
            "label",
            (F.col("Count") / F.col("_count")).alias("Count"),
            F.try_divide(F.col("Power"), F.col("_power")).alias("Power"),
        )
        .unpivot(["user_id", "label"], ["Count", "Power"], "Model", "probability")
    )
