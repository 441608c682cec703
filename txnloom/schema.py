"""Column contracts: what a transaction payload carries and what the target table stores.

Contracts are plain ``(name, type)`` tuples with DDL type names, so they can be
declared before a Spark session exists and handed to readers, ``from_json`` and
``CREATE TABLE`` alike.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "transaction_id"
EVENT_TIME = "timestamp"
VELOCITY = "velocity_last_hour"
CALENDAR = ("year", "month", "day", "hour", "minute")
PARTITION_COLUMNS = ("year", "month", "day")

# Field names, order and types of an incoming transaction.
TRANSACTION = (
    ("transaction_id", "string"),
    ("customer_id", "string"),
    ("card_number", "string"),
    ("timestamp", "timestamp"),
    ("merchant_category", "string"),
    ("merchant_type", "string"),
    ("merchant", "string"),
    ("amount", "float"),
    ("currency", "string"),
    ("country", "string"),
    ("city", "string"),
    ("city_size", "string"),
    ("card_type", "string"),
    ("card_present", "boolean"),
    ("device", "string"),
    ("channel", "string"),
    ("device_fingerprint", "string"),
    ("ip_address", "string"),
    ("distance_from_home", "int"),
    ("high_risk_merchant", "boolean"),
    ("transaction_hour", "int"),
    ("weekend_transaction", "boolean"),
    ("velocity_last_hour", "map<string,string>"),
    ("is_fraud", "boolean"),
)

FIELD_NAMES = tuple(name for name, _ in TRANSACTION)
HEADER_LINE = ",".join(FIELD_NAMES)

# The stored row: every input but the raw timestamp and the velocity map, money
# widened to double, then the calendar columns and the dollar amount.
TARGET = (
    tuple(
        (name, "double" if kind == "float" else kind)
        for name, kind in TRANSACTION
        if name not in (EVENT_TIME, VELOCITY)
    )
    + tuple((name, "int") for name in CALENDAR)
    + (("rate_usd", "double"),)
)
TARGET_NAMES = tuple(name for name, _ in TARGET)


def ddl(fields: Iterable[tuple[str, str]]) -> str:
    """Render a contract as a DDL schema string."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)


def all_string_ddl(names: Iterable[str] = FIELD_NAMES) -> str:
    return ddl((name, "string") for name in names)


def fields_of_type(kind: str) -> tuple[str, ...]:
    return tuple(name for name, declared in TRANSACTION if declared == kind)


def conform(df: DataFrame) -> DataFrame:
    """Select the 28 target columns in contract order, cast to their stored types.

    Raises at analysis time if a column is missing; extra columns are left out.
    """
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in TARGET))
