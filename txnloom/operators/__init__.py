from .calendar import add_calendar, normalize_timestamp
from .dedup import (
    drop_repeated_ids,
    drop_repeated_ids_spread,
    drop_repeated_ids_within,
    keep_first,
)
from .fx import FX_MODES, join_currency, usd_amount
from .parse import (
    cast_fields,
    coerce_strict,
    has_id,
    json_type_faults,
    parse_csv_line,
    parse_json,
    parse_wire_json,
    payload_to_string,
    rejected_csv,
    rejected_json,
)

__all__ = [
    "FX_MODES",
    "add_calendar",
    "cast_fields",
    "coerce_strict",
    "drop_repeated_ids",
    "drop_repeated_ids_spread",
    "drop_repeated_ids_within",
    "has_id",
    "join_currency",
    "json_type_faults",
    "keep_first",
    "normalize_timestamp",
    "parse_csv_line",
    "parse_json",
    "parse_wire_json",
    "payload_to_string",
    "rejected_csv",
    "rejected_json",
    "usd_amount",
]
