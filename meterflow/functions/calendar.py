"""Calendar expressions over zone-less timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_DAY = "1970-01-01"


def epoch_hour(ts: Column) -> Column:
    """Whole hours since 1970 of a wall-clock timestamp, as a long.

    ``date_trunc`` would turn a TIMESTAMP_NTZ into a zoned value and lose or
    double an hour at clock changes; a day number and an hour do not.
    """
    days = F.datediff(ts.cast("date"), F.lit(_EPOCH_DAY).cast("date"))
    return days.cast("long") * 24 + F.hour(ts)


def hour_start(hours: Column) -> Column:
    """The TIMESTAMP_NTZ at which an :func:`epoch_hour` begins."""
    midnight = F.date_add(F.lit(_EPOCH_DAY).cast("date"), F.floor(hours / 24).cast("int"))
    return midnight.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.pmod(hours, F.lit(24)).cast("int")
    )


def weekday_index(day: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(day)


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of ``period`` steps."""
    angle = value * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_fields(ts: Column) -> dict[str, Column]:
    """The nine calendar features of an hourly timestamp."""
    hour_sin, hour_cos = cycle(F.hour(ts), 24)
    dow_sin, dow_cos = cycle(weekday_index(ts), 7)
    return {
        "hour": F.hour(ts),
        "day_of_week": weekday_index(ts),
        "day_of_year": F.dayofyear(ts),
        "month": F.month(ts),
        "is_weekend": (weekday_index(ts) >= 5).cast("int"),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "dow_sin": dow_sin,
        "dow_cos": dow_cos,
    }


def hour_label(hour: Column) -> Column:
    """``17`` -> ``17:00 - 17:59``."""
    return F.format_string("%02d:00 - %02d:59", hour, hour)
