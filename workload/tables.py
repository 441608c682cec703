"""Transactions derived from the ``events`` and ``lineitem`` tables.

Each field is one SQL expression, in Spark's dialect and, where that differs, in
the checking database's. All fields are text, as a CSV file would hold them;
``TYPED`` gives the typed form of the non-text ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnloom.schema import FIELD_NAMES
from txnloom.session import size_scan
from txnloom.sources import parquet_rows, rates_from_mapping

# Invented rates, units per US dollar. Other codes count as unknown.
RATES = {"USD": 1.0, "EUR": 0.875, "JPY": 144.25, "GBP": 0.7525, "MXN": 18.375}

# The rates after an update: one changed, one gone, one new.
LATER_RATES = {"USD": 1.0, "EUR": 0.75, "GBP": 0.7525, "MXN": 18.375, "ZZZ": 2.0}

#: Ids that ``lookup_by_id`` asks for, some of which no table has.
LOOKED_UP = tuple(str(i) for i in (3, 150, 777, 999, 12345)) + ("none", "")

#: Rows in a file or a task, about, where a query makes its input.
FILE_ROWS = 250_000

#: Ids in each file that ``paced_ingest`` reads.
PACE = 1000

#: Its files for each stream, about, and its streams at most.
PACE_FILES, PACE_STREAMS = 100, 32

EVENTS = {
    "transaction_id": "CAST(event_id AS STRING)",
    "customer_id": "CAST(user_id AS STRING)",
    "card_number": "lpad(CAST(user_id AS STRING), 16, '4')",
    "timestamp": (
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') || '+00:00'",
        "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+00:00'",
    ),
    "merchant_category": "event_type",
    "merchant_type": "CASE WHEN event_type = 'purchase' THEN 'online' ELSE 'physical' END",
    "merchant": "'Café \"' || event_type || '\", No. ' || CAST(user_id AS STRING)",
    "amount": "CAST(value AS STRING)",
    "currency": (
        "CASE event_type WHEN 'view' THEN 'USD' WHEN 'purchase' THEN 'EUR' "
        "WHEN 'click' THEN 'JPY' WHEN 'signup' THEN 'ZZZ' ELSE '' END"
    ),
    "country": "'Country ' || event_type",
    "city": "'City ' || CAST(user_id AS STRING)",
    "city_size": "CASE WHEN user_id < 50 THEN 'large' ELSE 'medium' END",
    "card_type": (
        "CASE WHEN value < 50 THEN 'Basic' WHEN value < 150 THEN 'Gold' ELSE 'Platinum' END"
    ),
    "card_present": (
        "CASE event_type WHEN 'view' THEN 'false' WHEN 'purchase' THEN 'True' "
        "WHEN 'click' THEN 'y' WHEN 'signup' THEN 'maybe' ELSE '1' END"
    ),
    "device": "CASE WHEN event_type = 'click' THEN 'Chrome' ELSE 'iOS App' END",
    "channel": "CASE WHEN event_type = 'click' THEN 'web' ELSE 'mobile' END",
    "device_fingerprint": "md5(props)",
    "ip_address": "'10.0.' || CAST(user_id AS STRING) || '.1'",
    "distance_from_home": "CAST(user_id AS STRING) || '.7'",
    "high_risk_merchant": "CASE WHEN event_type = 'error' THEN 'TRUE' ELSE 'no' END",
    "transaction_hour": "CAST(hour(ts) AS STRING)",
    "weekend_transaction": (
        "CASE WHEN dayofweek(ts) IN (1, 7) THEN 'True' ELSE 'False' END",
        "CASE WHEN dayofweek(ts) IN (0, 6) THEN 'True' ELSE 'False' END",
    ),
    "velocity_last_hour": "props",
    "is_fraud": "CASE WHEN value > 150 THEN 'True' ELSE 'False' END",
}

# One transaction per order line under the order's id, so ids repeat and the
# copies differ.
LINES = {
    "transaction_id": "CAST(l_orderkey AS STRING)",
    "customer_id": "'S' || CAST(l_suppkey AS STRING)",
    "card_number": "lpad(CAST(l_partkey AS STRING), 16, '4')",
    "timestamp": (
        "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') || '+00:00'",
        "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '+00:00'",
    ),
    "merchant_category": "l_returnflag",
    "merchant_type": "l_linestatus",
    "merchant": "'Supplier ' || CAST(l_suppkey AS STRING) || ', Ltd'",
    "amount": "CAST(l_extendedprice AS STRING)",
    "currency": (
        "CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'USD' WHEN 'AO' THEN 'EUR' "
        "WHEN 'NF' THEN 'JPY' WHEN 'NO' THEN 'GBP' WHEN 'RF' THEN 'MXN' ELSE 'ZZZ' END"
    ),
    "country": "'Country ' || l_returnflag",
    "city": "'City ' || CAST(l_linenumber AS STRING)",
    "city_size": "CASE WHEN l_linenumber < 4 THEN 'large' ELSE 'medium' END",
    "card_type": "CASE WHEN l_discount < 0.05 THEN 'Basic' ELSE 'Gold' END",
    "card_present": "CASE WHEN l_linestatus = 'O' THEN 'True' ELSE 'False' END",
    "device": "'Device ' || CAST(l_linenumber AS STRING)",
    "channel": "CASE WHEN l_returnflag = 'R' THEN 'web' ELSE 'pos' END",
    "device_fingerprint": "md5(CAST(l_partkey AS STRING))",
    "ip_address": "'10.0.0.' || CAST(l_linenumber AS STRING)",
    "distance_from_home": "CAST(l_quantity AS STRING)",
    "high_risk_merchant": "CASE WHEN l_tax > 0.06 THEN 'True' ELSE 'False' END",
    "transaction_hour": "CAST(hour(l_shipdate) AS STRING)",
    "weekend_transaction": (
        "CASE WHEN dayofweek(l_shipdate) IN (1, 7) THEN 'True' ELSE 'False' END",
        "CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 'True' ELSE 'False' END",
    ),
    "velocity_last_hour": (
        "'{\"k\": ' || CAST(l_linenumber AS STRING) || ', \"d\": ' || "
        "CAST(l_discount AS STRING) || '}'"
    ),
    "is_fraud": "CASE WHEN l_extendedprice > 90000 THEN 'True' ELSE 'False' END",
}

# Lines that no CSV writer makes: quotes unpaired in every second row, up to four in a row, a
# line break, and the control characters by which a splitter might mark its cuts.
_ODD = (
    "transaction_id || ',' || merchant || ',' || CASE WHEN {id} % 2 = 0 THEN '\"' ELSE '' END || "
    "country || ',{feed},' || repeat('\"', CAST({id} % 5 AS INT)) || ',{mark}1,{mark}0' || city || "
    "',\"' || velocity_last_hour || '\",\"' || channel || ',' || CASE WHEN {id} % 3 = 0 THEN '\"' ELSE '' END"
)
ODD_LINE = (
    _ODD.format(id="CAST(transaction_id AS BIGINT)", feed="\\n", mark="\\u001e"),
    _ODD.format(
        id="CAST(transaction_id AS BIGINT)", feed="' || chr(10) || '", mark="' || chr(30) || '"
    ),
)

# Times of order lines as different senders write them: in two offsets, blank, missing, not a time.
MIXED_TIMES = tuple(
    "CASE city WHEN 'City 1' THEN timestamp "
    f"WHEN 'City 2' THEN {later} || '+05:00' WHEN 'City 3' THEN '' WHEN 'City 4' THEN NULL "
    "WHEN 'City 5' THEN 'soon' ELSE timestamp END"
    for later in (
        "date_format(CAST(substr(timestamp, 1, 19) AS TIMESTAMP) + INTERVAL 5 HOURS, 'yyyy-MM-dd HH:mm:ss')",
        "strftime(CAST(substr(timestamp, 1, 19) AS TIMESTAMP) + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S')",
    )
)

#: How many lines ``src_first_lines`` asks for.
FIRST_LINES = 1000

FIELDS = {"events": EVENTS, "lineitem": LINES}


def field_sql(table: str, name: str, dialect: str) -> str:
    given = FIELDS[table][name]
    if isinstance(given, str):
        return given
    return given[0] if dialect == "spark" else given[1]


def text_rows(source: DataFrame, table: str) -> DataFrame:
    """The 24 fields as text, from a batch or streaming read of ``table``."""
    return source.selectExpr(
        *(f"{field_sql(table, name, 'spark')} AS {name}" for name in FIELD_NAMES)
    )


def read_rows(spark: SparkSession, sf_dir: str, table: str, streaming: bool = False) -> DataFrame:
    path = f"{sf_dir}/{table}.parquet"
    if not streaming:
        size_scan(spark, path)
    return text_rows(parquet_rows(spark, path, streaming=streaming), table)


def pieces(spark: SparkSession, sf_dir: str, table: str, rows: int = FILE_ROWS) -> int:
    """How many files or tasks of at most ``rows`` rows, about, hold the table; at least one."""
    return max(1, math.ceil(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / rows))


def csv_line(rows: DataFrame) -> Column:
    """A row as one CSV line, quoted where needed, quotes doubled."""
    return F.to_csv(F.struct(*rows.columns), {"escape": '"', "emptyValue": ""})


def csv_lines(rows: DataFrame) -> DataFrame:
    return rows.select(csv_line(rows).alias("value"))


def rates(spark: SparkSession) -> DataFrame:
    return rates_from_mapping(spark, RATES)
