from .calendar import calendar_fields, cycle, epoch_hour, hour_label, hour_start, weekday_index
from .cleaning import NA_TOKENS, known_rows, na_to_null, reading_timestamp, to_number

__all__ = [
    "NA_TOKENS",
    "calendar_fields",
    "cycle",
    "epoch_hour",
    "hour_label",
    "hour_start",
    "known_rows",
    "na_to_null",
    "reading_timestamp",
    "to_number",
    "weekday_index",
]
