"""Event-time operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import calendar_columns, to_instant, utc_millis_text
from ..schema import EVENT_TIME


def add_calendar(
    df: DataFrame, column: str = EVENT_TIME, string_rule: bool = False
) -> DataFrame:
    """Add year, month, day, hour and minute of ``column`` in the session zone.

    Text is read as one instant, offset included. With ``string_rule`` the date
    parts of a text column come from the date as written, ignoring the offset,
    while hour and minute come from the instant; near midnight the two disagree.
    """
    value = F.col(column)
    if df.schema[column].dataType.typeName() != "string":
        return df.withColumns(calendar_columns(value, value))
    if string_rule:
        return df.withColumns(
            calendar_columns(value.try_cast("date"), value.try_cast("timestamp"))
        )
    # The parsed instant is a column of its own so that it is parsed once, not per part.
    parsed = df.withColumn("_instant", to_instant(value))
    instant = F.col("_instant")
    return parsed.withColumns(calendar_columns(instant, instant)).drop("_instant")


def normalize_timestamp(df: DataFrame, column: str = EVENT_TIME) -> DataFrame:
    """Rewrite ISO-8601 text as UTC with milliseconds and ``Z``; bad text gives null."""
    return df.withColumn(column, utc_millis_text(to_instant(F.col(column))))
