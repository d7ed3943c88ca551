"""Seeded synthetic readings and small hand-made hourly tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.functions import weekday_index
from meterflow.schema import CURRENT, DATETIME, POWER, RAW_COLUMNS, VOLTAGE

HOURLY_SCHEMA = T.StructType(
    [
        T.StructField(DATETIME, T.TimestampNTZType()),
        T.StructField(POWER, T.DoubleType()),
        T.StructField(VOLTAGE, T.DoubleType()),
        T.StructField(CURRENT, T.DoubleType()),
    ]
)


def minute_readings(spark: SparkSession, days: int = 45) -> DataFrame:
    """One reading a minute: a daily sine, a weekly cosine and noise, as text."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    moment = start + F.make_dt_interval(mins=F.col("id").cast("int"))
    rows = spark.range(days * 24 * 60, numPartitions=4).withColumn("at", moment)
    daily = F.sin(F.hour("at") * 6.283185307179586 / 24)
    weekly = F.cos(weekday_index(F.col("at")) * 6.283185307179586 / 7)
    power = F.greatest(2.8 + 0.9 * daily + 0.4 * weekly + 0.08 * F.randn(42), F.lit(0.2))
    rows = rows.withColumn("power", power)
    return rows.select(
        F.date_format("at", "dd/MM/yyyy").alias("Date"),
        F.date_format("at", "HH:mm:ss").alias("Time"),
        F.col("power").cast("string").alias("Global_active_power"),
        F.greatest(F.col("power") * 0.25, F.lit(0.01)).cast("string").alias("Global_reactive_power"),
        (236 + 2 * F.randn(43)).cast("string").alias("Voltage"),
        F.greatest(F.col("power") * 4.2 + 0.3 * F.randn(44), F.lit(0.1))
        .cast("string")
        .alias("Global_intensity"),
        (2 * F.rand(45)).cast("string").alias("Sub_metering_1"),
        (2 * F.rand(46)).cast("string").alias("Sub_metering_2"),
        (2 * F.rand(47)).cast("string").alias("Sub_metering_3"),
    ).select(*RAW_COLUMNS)


def hourly_rows(
    spark: SparkSession, powers: list[float], hours: list[int] | None = None
) -> DataFrame:
    """Hourly rows from 2024-01-01 on, at the given hour numbers."""
    hours = hours if hours is not None else list(range(len(powers)))
    start = dt.datetime(2024, 1, 1)
    rows = [
        (start + dt.timedelta(hours=hour), float(p), 230.0 + i, 4.2 * p + 0.1)
        for i, (hour, p) in enumerate(zip(hours, powers, strict=True))
    ]
    return spark.createDataFrame(rows, HOURLY_SCHEMA)
