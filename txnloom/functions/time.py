"""Column expressions for event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event times start with a four-digit year.
YEAR_FIRST = r"^\s*\d{4}"


def to_instant(text: Column) -> Column:
    """ISO-8601 text as a timestamp; text without an offset is session-local.

    Text that does not start with a year is null: Spark would otherwise read a
    bare ``12:30`` as today's 12:30.
    """
    return F.when(text.rlike(YEAR_FIRST), text.try_cast("timestamp"))


def utc_millis_text(instant: Column) -> Column:
    """Format a timestamp as UTC ISO-8601 with milliseconds (truncated) and ``Z``.

    Works from the epoch, so the session zone and its clock changes play no part.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wall = F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)
    fraction = F.lpad(F.pmod(F.unix_millis(instant), F.lit(1000)).cast("string"), 3, "0")
    return F.concat(
        F.translate(wall.cast("string"), " ", "T"), F.lit("."), fraction, F.lit("Z")
    )


def calendar_columns(date_part: Column, time_part: Column) -> dict[str, Column]:
    return {
        "year": F.year(date_part),
        "month": F.month(date_part),
        "day": F.dayofmonth(date_part),
        "hour": F.hour(time_part),
        "minute": F.minute(time_part),
    }
