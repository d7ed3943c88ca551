"""Result tables as CSV, JSON or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).csv(path)


def write_json(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").json(path)


def write_parquet(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def as_records(table: DataFrame) -> list[dict]:
    """A report table of a few rows, such as the leaderboard, as dictionaries."""
    return [row.asDict() for row in table.collect()]
