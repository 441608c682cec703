from .enrich import enrich, enrich_csv, enrich_json
from .publish import (
    MESSAGE_KEY,
    json_envelope,
    json_value,
    line_envelope,
    normalize_messages,
    publish_json,
)

__all__ = [
    "MESSAGE_KEY",
    "enrich",
    "enrich_csv",
    "enrich_json",
    "json_envelope",
    "json_value",
    "line_envelope",
    "normalize_messages",
    "publish_json",
]
