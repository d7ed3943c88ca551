"""Expressions that turn reading text into typed values or NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The question mark of the meter export, and the tokens a pandas
# CSV reader takes as missing by default.
NA_TOKENS = [
    "?",
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# What counts as a number. Spark's own cast also takes Java literals such as
# "12d" or "0x1p3", which a meter export never means as a reading.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"

_UTC_EPOCH = "1970-01-01 00:00:00Z"


def na_to_null(text: Column) -> Column:
    """Missing-value tokens become NULL."""
    return F.when(~text.isin(NA_TOKENS), text)


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL, never NaN."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def known_rows(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL or NaN.

    ``na.drop`` means the same but hides its columns from the file reader;
    plain null checks reach the scan as pushed filters.
    """
    kinds = dict(table.dtypes)
    checks = [f"`{name}` IS NOT NULL" for name in names]
    checks += [f"NOT isnan(`{name}`)" for name in names if kinds[name] == "double"]
    return table.filter(" AND ".join(checks))


def reading_timestamp(date: Column, time: Column) -> Column:
    """Day-first date and time text to TIMESTAMP_NTZ; NULL where it is no such time.

    The text is read at offset zero and moved to a zone-less value by its
    distance from the epoch, so the session time zone never shifts a reading.
    """
    text = F.concat(date, F.lit(" "), time, F.lit(" +0000"))
    instant = F.try_to_timestamp(text, F.lit("d/M/yyyy H:m:s Z"))
    since_epoch = instant - F.lit(_UTC_EPOCH).cast("timestamp")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch
