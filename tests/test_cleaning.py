from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow import load_raw_data, preprocess_hourly
from meterflow.functions import epoch_hour, hour_start, known_rows, reading_timestamp, to_number
from meterflow.schema import RAW_COLUMNS


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_are_day_first_and_zone_free(spark, zone):
    rows = [
        ("1/2/2024", "3:04:05"),
        ("16/12/2006", "17:24:00"),
        ("10/03/2024", "02:30:00"),
        ("31/02/2024", "00:00:00"),
        ("2024-01-05", "00:00:00"),
        ("1/2/2024", "25:00:00"),
        ("?", "00:00:00"),
        (None, "00:00:00"),
        ("1/2/2024", None),
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        table = spark.createDataFrame(rows, "d string, t string")
        parsed = table.select(reading_timestamp(F.col("d"), F.col("t")).alias("x"))
        again = parsed.select("x", hour_start(epoch_hour(F.col("x"))).alias("h")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [row.x for row in again] == [
        dt.datetime(2024, 2, 1, 3, 4, 5),
        dt.datetime(2006, 12, 16, 17, 24),
        dt.datetime(2024, 3, 10, 2, 30),
        *[None] * 6,
    ]
    assert [row.h for row in again[:3]] == [
        dt.datetime(2024, 2, 1, 3),
        dt.datetime(2006, 12, 16, 17),
        dt.datetime(2024, 3, 10, 2),
    ]


def test_hours_before_the_epoch(spark):
    table = spark.sql("SELECT timestamp_ntz'1969-12-31 22:45:00' AS t")
    row = table.select(epoch_hour(F.col("t")).alias("n"), hour_start(epoch_hour(F.col("t"))).alias("h"))
    assert row.first() == (-2, dt.datetime(1969, 12, 31, 22))


def test_numbers(spark):
    cases = {
        "1.5": 1.5, " 12 ": 12.0, "-.5e1": -5.0, "7.": 7.0, "+3": 3.0,
        "12d": None, "1.5f": None, "0x1p3": None, "1_0": None, "?": None, "": None,
        "abc": None, "NaN": None, "inf": float("inf"), "-Infinity": float("-inf"), None: None,
    }
    table = spark.createDataFrame([(text,) for text in cases], "s string")
    found = {row.s: row.x for row in table.select("s", to_number(F.col("s")).alias("x")).collect()}
    assert found == cases


def test_known_rows(spark):
    rows = [(1.0, "a"), (float("nan"), "a"), (float("inf"), "a"), (None, "a"), (1.0, None)]
    table = known_rows(spark.createDataFrame(rows, "x double, s string"), ["x", "s"])
    assert [row.x for row in table.collect()] == [1.0, float("inf")]


def test_reader_and_hourly_table(spark, tmp_path):
    path = tmp_path / "readings.csv"
    header = ";".join(RAW_COLUMNS)
    lines = [
        "1/1/2024;0:00:00;1.0;0;230;4;0;0;0",
        "1/1/2024;0:30:00;3.0;?;232;6;0;0;0",
        "1/1/2024;0:45:00;?;0;232;6;0;0;0",
        "1/1/2024;2:00:00;5.0;0;NaN;6;0;0;0",
        "1/1/2024;3:00:00;5.0;0;null;6;0;0;0",
        "31/2/2024;3:00:00;5.0;0;230;6;0;0;0",
        "1/1/2024;5:10:00;2.0;NA;231;8;;;",
    ]
    path.write_text("\n".join([header, *lines]) + "\n")
    raw = load_raw_data(spark, str(path))
    assert raw.columns == RAW_COLUMNS
    assert raw.filter(F.col("Global_reactive_power").isNull()).count() == 2
    rows = preprocess_hourly(raw).orderBy("datetime").collect()
    assert [tuple(row) for row in rows] == [
        (dt.datetime(2024, 1, 1, 0), 2.0, 231.0, 5.0),
        (dt.datetime(2024, 1, 1, 5), 2.0, 231.0, 8.0),
    ]


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "meters.csv"
    names = ["meter", *reversed(RAW_COLUMNS), "note"]
    path.write_text(";".join(names) + "\na;1;2;3;4;230;5;6;0:00:00;1/1/2024;x\n")
    row = load_raw_data(spark, str(path), ["meter"]).first()
    assert (row.meter, row.Date, row.Voltage, row.Global_active_power) == ("a", "1/1/2024", "230", "6")


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_raw_data(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(FileNotFoundError):
        load_raw_data(spark)


def test_opposite_infinities_are_missing(spark):
    rows = [("1/1/2024", "0:00:00", "inf"), ("1/1/2024", "0:10:00", "-inf"), ("1/1/2024", "1:00:00", "2")]
    raw = spark.createDataFrame(
        [(d, t, p, "0", "230", "4", "0", "0", "0") for d, t, p in rows],
        ", ".join(f"{name} string" for name in RAW_COLUMNS),
    )
    assert [row.Global_active_power for row in preprocess_hourly(raw).collect()] == [2.0]
