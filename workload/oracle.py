"""The same queries as SQL for the checking database, over the same tables.

Each statement is written from the field definitions and the rules themselves;
none of them reads what Spark rendered.
"""

from __future__ import annotations

from txnloom.schema import FIELD_NAMES, HEADER_LINE, TARGET_NAMES, VELOCITY

from .tables import (
    FIRST_LINES,
    LATER_RATES,
    LOOKED_UP,
    MIXED_TIMES,
    ODD_LINE,
    PACE,
    RATES,
    field_sql,
)

FLAGS = ("card_present", "high_risk_merchant", "weekend_transaction", "is_fraud")
INTEGERS = ("distance_from_home", "transaction_hour")



def rates_cte(rates: dict[str, float]) -> str:
    rows = ", ".join(f"('{code}', CAST({rate} AS DOUBLE))" for code, rate in rates.items())
    return f"rates(currency, rate) AS (VALUES {rows})"


RATES_CTE = rates_cte(RATES)

OFFSET_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '-05:00'"
UTC_MILLIS = (
    "strftime({0}, '%Y-%m-%dT%H:%M:%S.') || "
    "lpad(CAST(millisecond({0}) % 1000 AS VARCHAR), 3, '0') || 'Z'"
)


def rows_cte(table: str) -> str:
    fields = ", ".join(f"{field_sql(table, name, 'duck')} AS {name}" for name in FIELD_NAMES)
    return f"tx AS (SELECT {fields} FROM {table})"


def csv_field(name: str) -> str:
    """A field as a CSV writer renders it: quoted when it holds a comma or a quote."""
    return (
        f"CASE WHEN contains({name}, ',') OR contains({name}, '\"') "
        f"THEN '\"' || replace({name}, '\"', '\"\"') || '\"' ELSE {name} END"
    )


CSV_LINE = " || ',' || ".join(csv_field(name) for name in FIELD_NAMES)


def loose_int(name: str) -> str:
    return f"CAST(trunc(TRY_CAST({name} AS DOUBLE)) AS INTEGER)"


def loose_bool(name: str) -> str:
    return (
        f"CASE WHEN lower({name}) IN ('t', 'true', 'y', 'yes', '1') THEN true "
        f"WHEN lower({name}) IN ('f', 'false', 'n', 'no', '0') THEN false END"
    )


def literal_true(name: str) -> str:
    return f"lower({name}) = 'true'"


def float32(name: str) -> str:
    return f"CAST(CAST({name} AS FLOAT) AS DOUBLE)"


def as_typed(name: str, flag=loose_bool, quoted: bool = False) -> str:
    if name in FLAGS:
        return flag(name)
    if name in INTEGERS:
        return loose_int(name)
    if name == "amount":
        return float32(name)
    return csv_field(name) if quoted else name


def as_shown(name: str) -> str:
    return f"coalesce({loose_bool(name)}, false)" if name == "card_present" else as_typed(name)


FLAG_KNOWN = f"({loose_bool('card_present')}) IS NOT NULL AS card_present_known"


def listing(names, render) -> str:
    return ", ".join(f"{render(name)} AS {name}" for name in names)


def select_rows(table: str, names, render=lambda name: name) -> str:
    return f"WITH {rows_cte(table)} SELECT {listing(names, render)} FROM tx"


EVENT_TEXT = "substr(timestamp, 1, 26)"
EVENT_MILLIS = UTC_MILLIS.format(f"CAST({EVENT_TEXT} AS TIMESTAMP)")
NO_VELOCITY = tuple(name for name in FIELD_NAMES if name != VELOCITY)


def from_json(name: str) -> str:
    return EVENT_TEXT if name == "timestamp" else as_typed(name, literal_true)


def from_json_strict(name: str) -> str:
    return "CAST(0 AS INTEGER)" if name in INTEGERS else from_json(name)


def json_text(timestamp: str) -> str:
    def value(name: str) -> str:
        if name in FLAGS:
            return literal_true(name)
        if name in ("amount", "distance_from_home"):
            return f"CAST({name} AS DOUBLE)"
        return timestamp if name == "timestamp" else name

    members = ", ".join(f"'{name}', {value(name)}" for name in FIELD_NAMES)
    return f"CAST(json_object({members}) AS VARCHAR)"


def calendar(date_part: str, time_part: str) -> str:
    return (
        f"CAST(year({date_part}) AS INTEGER) AS year, "
        f"CAST(month({date_part}) AS INTEGER) AS month, "
        f"CAST(day({date_part}) AS INTEGER) AS day, CAST(hour({time_part}) AS INTEGER) AS hour, "
        f"CAST(minute({time_part}) AS INTEGER) AS minute"
    )


def event_calendar(date_part: str, time_part: str) -> str:
    parts = calendar(date_part, time_part)
    return f"SELECT CAST(event_id AS VARCHAR) AS transaction_id, {parts} FROM events"


def keep_first(source: str, left_out: tuple[str, ...] = (VELOCITY,)) -> str:
    """One row per id: the earliest, ties broken by the other columns in order."""
    rest = [n for n in FIELD_NAMES if n not in ("transaction_id", "timestamp", *left_out)]
    order = ", ".join(f"{name} NULLS FIRST" for name in ["timestamp", *rest])
    return (
        f"SELECT * FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {order}) = 1"
    )


def target_ctes(table: str, fx: str, flag, quoted: bool) -> str:
    """CTEs ending in ``target``: de-duplicated, dated and converted rows."""
    typed = listing(NO_VELOCITY, lambda name: as_typed(name, flag, quoted))
    instant = "CAST(substr(timestamp, 1, 19) AS TIMESTAMP)"
    kept = ", ".join(name for name in TARGET_NAMES if name in FIELD_NAMES)
    return (
        f"{rows_cte(table)}, typed AS (SELECT {typed} FROM tx), uniq AS ({keep_first('typed')}), "
        f"target AS (SELECT {kept}, {calendar(instant, instant)}, "
        f"amount {fx} rate AS rate_usd FROM uniq LEFT JOIN rates USING (currency))"
    )


def target_sql(table: str, fx: str, flag=loose_bool, quoted: bool = False) -> str:
    names = ", ".join(TARGET_NAMES)
    return f"WITH {RATES_CTE}, {target_ctes(table, fx, flag, quoted)} SELECT {names} FROM target"


def amounts_sql(column: str) -> str:
    return (
        f"WITH {RATES_CTE}, {rows_cte('lineitem')}, "
        f"money AS (SELECT transaction_id, city, {float32('amount')} AS amount, currency FROM tx) "
        f"SELECT transaction_id, city, amount, currency, {column} "
        f"FROM money LEFT JOIN rates USING (currency)"
    )


EVENT_TARGET = target_sql("events", "*", literal_true)


def rate_update_sql() -> str:
    """Even ids by the first rates, odd ones by the later."""
    names = ", ".join(TARGET_NAMES)
    ctes = target_ctes("events", "*", literal_true, False)
    halves = [
        f"SELECT * FROM (WITH {rates_cte(rates)}, {ctes} SELECT {names} FROM target "
        f"WHERE CAST(transaction_id AS BIGINT) % 2 = {part})"
        for part, rates in enumerate((RATES, LATER_RATES))
    ]
    return " UNION ALL ".join(halves)


def faults_sql() -> str:
    """Tokens that their declared types can't hold, counted by the rules of the messages.

    Both integers come as other tokens, and the velocity map as text; every fifth message
    has a flag as text, and every seventh is cut short.
    """
    whole = "CAST(transaction_id AS BIGINT) % 7 <> 0"
    rows = [
        ("distance_from_home", "DECIMAL", whole),
        ("transaction_hour", "STRING", whole),
        ("velocity_last_hour", "STRING", whole),
        ("card_present", "STRING", f"{whole} AND CAST(transaction_id AS BIGINT) % 5 = 0"),
        ("-", "no object", f"NOT ({whole})"),
    ]
    return f"WITH {rows_cte('events')} " + " UNION ALL ".join(
        f"SELECT '{field}' AS field, '{found}' AS found, count(*) AS n FROM tx WHERE {rule}"
        for field, found, rule in rows
    )


def idempotent_append_sql() -> str:
    names = ", ".join(TARGET_NAMES)
    others = names.replace("transaction_id", "'E' || transaction_id AS transaction_id")
    ctes = target_ctes("events", "*", literal_true, False)
    return (
        f"WITH {RATES_CTE}, {ctes} SELECT {names} FROM target "
        f"UNION ALL SELECT {others} FROM target"
    )


def unique_sql() -> str:
    typed = listing(FIELD_NAMES, as_typed)
    return (
        f"WITH {rows_cte('lineitem')}, typed AS (SELECT {typed} FROM tx) "
        f"{keep_first('typed', left_out=())}"
    )


def mixed_times_sql() -> str:
    """As ``unique_sql``, by the instant of times that can be read."""
    typed = listing(FIELD_NAMES, lambda n: MIXED_TIMES[1] if n == "timestamp" else as_typed(n))
    readable = "CASE WHEN city IN ('City 3', 'City 4', 'City 5') THEN NULL ELSE "
    instant = f"{readable} CAST(substr(timestamp, 1, 19) AS TIMESTAMP) END"
    order = ", ".join(f"{name} NULLS FIRST" for name in FIELD_NAMES if name != "transaction_id")
    names = ", ".join(FIELD_NAMES)
    return (
        f"WITH {rows_cte('lineitem')}, typed AS (SELECT {typed}, {instant} AS instant FROM tx) "
        f"SELECT {names} FROM typed QUALIFY row_number() OVER "
        f"(PARTITION BY transaction_id ORDER BY instant NULLS LAST, {order}) = 1"
    )


def wire_sql() -> str:
    def value(name: str) -> str:
        if name in FLAGS:
            return literal_true(name)
        return f"CAST({name} AS DOUBLE)" if name in ("amount", "distance_from_home") else name

    return (
        f"WITH {rows_cte('events')} SELECT 'Transaction' AS key, "
        f"{listing(FIELD_NAMES, value)} FROM tx"
    )


def strict_json_sql() -> str:
    return (
        f"WITH {rows_cte('events')} SELECT {listing(NO_VELOCITY, from_json_strict)}, "
        f"json_extract_string({VELOCITY}, '$.k') AS velocity_k, "
        "false AS distance_from_home_known, false AS transaction_hour_known FROM tx"
    )


def odd_sql() -> str:
    """Fields between the commas that an even number of quotes follows, counted for each comma."""
    names = ", ".join(f"fields[{i}] AS {name}" for i, name in enumerate(FIELD_NAMES, 1))
    return (
        f"WITH {rows_cte('events')}, lines AS (SELECT {ODD_LINE[1]} AS v FROM tx), "
        "places AS (SELECT v, string_split(v, ',') AS bits FROM lines), "
        "cuts AS (SELECT v, bits, list_filter(range(1, len(bits)), lambda i: "
        "(length(v) - length(replace(v, '\"', '')) - "
        "length(array_to_string(bits[:i], '')) + length(replace(array_to_string(bits[:i], ''), '\"', ''))) "
        "% 2 = 0) AS ends FROM places), "
        "cut AS (SELECT list_transform(range(0, len(ends) + 1), lambda k: array_to_string("
        "bits[CASE WHEN k = 0 THEN 1 ELSE ends[k] + 1 END : "
        "CASE WHEN k = len(ends) THEN len(bits) ELSE ends[k + 1] END], ',')) AS fields FROM cuts) "
        f"SELECT {names} FROM cut"
    )


def _unquoted(name: str) -> str:
    return f"nullif({name}, '')"


UNIQUE_EVENTS = select_rows("events", ("transaction_id", "timestamp", "merchant"))

ORACLE: dict[str, str] = {
    "src_csv_header": select_rows("events", FIELD_NAMES),
    "src_csv_multiline": select_rows(
        "events",
        FIELD_NAMES,
        lambda name: "merchant || chr(10) || city" if name == "merchant" else name,
    ),
    "src_text_lines": (
        f"WITH {rows_cte('events')} SELECT {CSV_LINE} AS value FROM tx UNION ALL "
        f"SELECT '{HEADER_LINE}' FROM tx WHERE CAST(transaction_id AS BIGINT) % 3 = 2"
    ),
    "src_first_lines": (
        f"WITH {rows_cte('events')} SELECT {CSV_LINE} AS value FROM tx "
        f"ORDER BY CAST(transaction_id AS BIGINT) LIMIT {FIRST_LINES}"
    ),
    "src_json_stream": wire_sql(),
    "dim_currency": (
        f"WITH {RATES_CTE}, {rows_cte('events')} SELECT DISTINCT currency, rate "
        f"FROM tx LEFT JOIN rates USING (currency)"
    ),
    "payload_to_string": f"WITH {rows_cte('events')} SELECT {CSV_LINE} AS value FROM tx",
    "parse_json": select_rows("events", NO_VELOCITY, from_json),
    "parse_json_strict": strict_json_sql(),
    "parse_csv_line": select_rows("events", FIELD_NAMES, csv_field),
    "parse_csv_unquoted": select_rows("events", FIELD_NAMES, _unquoted),
    "parse_csv_odd": odd_sql(),
    "json_type_faults": faults_sql(),
    "cast_fields": (
        f"WITH {rows_cte('events')} SELECT {listing(FIELD_NAMES, as_shown)}, {FLAG_KNOWN} FROM tx"
    ),
    "coerce_strict": select_rows(
        "events",
        FIELD_NAMES,
        lambda name: literal_true(name)
        if name in FLAGS
        else f"CAST({name} AS DOUBLE)"
        if name in ("amount", "distance_from_home")
        else name,
    ),
    "calendar_parts": event_calendar("ts", "ts"),
    "calendar_parts_string": event_calendar("ts", "(ts + INTERVAL 5 HOUR)"),
    "calendar_parts_instant": event_calendar(
        "(ts + INTERVAL 5 HOUR)", "(ts + INTERVAL 5 HOUR)"
    ),
    "normalize_timestamp": (
        "SELECT CAST(event_id AS VARCHAR) AS transaction_id, "
        f"{UTC_MILLIS.format('(ts + INTERVAL 5 HOUR)')} AS timestamp FROM events"
    ),
    "normalize_messages": (
        f"WITH {rows_cte('events')} SELECT 'Transaction' AS key, "
        f"{json_text(EVENT_MILLIS)} AS value FROM tx"
    ),
    "normalize_nested": (
        f"WITH {rows_cte('events')} SELECT 'Transaction' AS key, "
        "'{\"extra\":1.50,\"in\":{\"timestamp\":\"' || timestamp || '\",\"n\":12.0},' || "
        f"substr({json_text(EVENT_MILLIS)}, 2) AS value FROM tx"
    ),
    "join_currency_left": amounts_sql("rate"),
    "fx_divide": amounts_sql("amount / rate AS rate_usd"),
    "fx_multiply": amounts_sql("amount * rate AS rate_usd"),
    "dedup_transaction_id": unique_sql(),
    "dedup_mixed_times": mixed_times_sql(),
    "to_json_envelope": (
        f"WITH {rows_cte('events')} SELECT 'Transaction' AS key, "
        f"{json_text('timestamp')} AS value FROM tx"
    ),
    "to_line_envelope": (
        f"WITH {rows_cte('lineitem')} SELECT 'Transaction' AS key, {CSV_LINE} AS value FROM tx"
    ),
    "target_contract": EVENT_TARGET,
    "sink_foreach_batch": EVENT_TARGET,
    "sink_idempotent_append": idempotent_append_sql(),
    "partitioned_sink_lookup": (
        f"SELECT * FROM ({EVENT_TARGET}) WHERE year = 2024 AND month = 1 AND day = 1 "
        "AND transaction_id = '150'"
    ),
    "stream_enrich": (
        "SELECT * REPLACE (coalesce(card_present, false) AS card_present), "
        "card_present IS NOT NULL AS card_present_known "
        f"FROM ({target_sql('events', '/', loose_bool, True)})"
    ),
    "stream_dedup": UNIQUE_EVENTS,
    "stream_dedup_spread": UNIQUE_EVENTS,
    "stream_dedup_within": UNIQUE_EVENTS,
    "sink_redelivery": EVENT_TARGET,
    "bucketed_append": idempotent_append_sql(),
    "lookup_by_id": (
        f"SELECT * FROM ({EVENT_TARGET}) WHERE transaction_id IN "
        f"({', '.join(repr(i) for i in LOOKED_UP)})"
    ),
    "stream_earliest": unique_sql(),
    "paced_ingest": f"SELECT count(*) AS n_rows FROM events GROUP BY event_id // {PACE}",
    "graceful_stop": EVENT_TARGET,
    "stream_rate_update": rate_update_sql(),
    "stream_chain": EVENT_TARGET,
    "enrich_csv": target_sql("lineitem", "/", loose_bool, True),
    "enrich_json": target_sql("lineitem", "*", literal_true),
}
