from .text import (
    is_literal_true,
    split_csv_line,
    strict_double,
    strip,
    to_bool,
    to_float,
    to_int,
)
from .time import calendar_columns, to_instant, utc_millis_text

__all__ = [
    "calendar_columns",
    "is_literal_true",
    "split_csv_line",
    "strict_double",
    "strip",
    "to_bool",
    "to_float",
    "to_instant",
    "to_int",
    "utc_millis_text",
]
