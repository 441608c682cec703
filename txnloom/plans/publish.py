"""Message building: what goes onto a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.time import to_instant, utc_millis_text
from ..operators import coerce_strict
from ..schema import EVENT_TIME

# Fixed value: the key every published message carries.
MESSAGE_KEY = "Transaction"


def _key(key_column: str | None) -> Column:
    return F.lit(MESSAGE_KEY) if key_column is None else F.col(key_column).cast("string")


def json_value(df: DataFrame) -> Column:
    """The whole row as one JSON object, null fields written out."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def json_envelope(df: DataFrame, key_column: str | None = None) -> DataFrame:
    """``key, value`` messages with the row as JSON.

    The default key is one constant, which a hash partitioner sends to a single
    topic partition. Name a ``key_column`` to spread messages over all of them.
    """
    return df.select(_key(key_column).alias("key"), json_value(df).alias("value"))


def line_envelope(lines: DataFrame, column: str = "value") -> DataFrame:
    """``key, value`` messages with the stripped line as it is."""
    return lines.select(
        F.lit(MESSAGE_KEY).alias("key"), strip(F.col(column)).alias("value")
    )


def publish_json(rows: DataFrame, key_column: str | None = None) -> DataFrame:
    """CSV rows, all text, to typed JSON messages."""
    return json_envelope(coerce_strict(rows), key_column)


# The time of a message, where it is text, with all before it as the first group.
TIME_TEXT = r'("timestamp"\s*:\s*)"[^"]*"'


# Stand for escaped quotes and backslashes while strings are told from what is between them.
_ESCAPES = (("\x1e", "\x1e0"), ("\\\\", "\x1e1"), ('\\"', "\x1e2"))


def _top_level_time(value: Column, time: Column) -> Column:
    """A JSON object with the text of its own time replaced, not that of objects inside it."""
    for found, mark in _ESCAPES:
        value = F.replace(value, F.lit(found), F.lit(mark))
    # every second piece is a string
    pieces = F.split(value, '"')

    def bare(piece: Column, brackets: str) -> Column:
        return F.length(piece) - F.length(F.translate(piece, brackets, ""))

    def step(seen: Column, piece: Column) -> Column:
        i = seen["i"]
        text = i.bitwiseAND(F.lit(1)) == 1
        opened = F.when(text, 0).otherwise(bare(piece, "{[") - bare(piece, "}]"))
        follows = ~text & seen["named"] & piece.rlike(r"^\s*:\s*$")
        spots = seen["spots"]
        return F.struct(
            (i + 1).alias("i"),
            (seen["depth"] + opened).alias("depth"),
            (text & (seen["depth"] == 1) & (piece == EVENT_TIME)).alias("named"),
            F.when(follows, F.array_append(spots, i + 1)).otherwise(spots).alias("spots"),
        )

    start = F.struct(
        F.lit(0).alias("i"),
        F.lit(0).alias("depth"),
        F.lit(False).alias("named"),
        F.array().cast("array<int>").alias("spots"),
    )
    replaced = F.aggregate(
        pieces,
        start,
        step,
        lambda seen: F.transform(
            pieces,
            lambda piece, i: F.when(F.array_contains(seen["spots"], i), time).otherwise(piece),
        ),
    )
    value = F.array_join(replaced, '"')
    for found, mark in reversed(_ESCAPES):
        value = F.replace(value, F.lit(mark), F.lit(found))
    return value


def normalize_messages(payloads: DataFrame, key_column: str | None = None) -> DataFrame:
    """JSON messages with a UTC millisecond timestamp, every other byte as it was.

    The incoming ``key`` is passed on, unless ``key_column`` names a field to key
    by. What is not a JSON object, and a time that can't be read, are passed on as
    they are, and so are equal names inside nested objects.
    """
    forward = key_column is None and "key" in payloads.columns
    value = F.col("value").cast("string")
    time = utc_millis_text(to_instant(F.from_json(value, f"{EVENT_TIME} string")[EVENT_TIME]))
    quoted = F.concat(F.lit('"'), time, F.lit('"'))
    in_place = F.regexp_replace(value, F.lit(TIME_TEXT), F.concat(F.lit("$1"), quoted))
    anew = _top_level_time(value, time)
    once = F.regexp_count(value, F.lit(f'"{EVENT_TIME}"')) == 1
    fixed = F.when(time.isNull(), value).when(once, in_place).otherwise(anew)
    if forward:
        key = F.col("key").cast("string")
    elif key_column is not None:
        key = F.from_json(value, f"{key_column} string")[key_column]
    else:
        key = _key(None)
    return payloads.select(key.alias("key"), fixed.alias("value"))
