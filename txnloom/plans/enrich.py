"""The two enrichment pipelines, from raw payload to target row.

Repeats are removed before the calendar and currency steps: those add one value
per row and never change the set of ids, so doing it first shuffles the narrower
row and looks up fewer rates. The shuffle on the id is the only one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (
    add_calendar,
    cast_fields,
    drop_repeated_ids,
    drop_repeated_ids_spread,
    drop_repeated_ids_within,
    has_id,
    parse_csv_line,
    parse_json,
    payload_to_string,
    usd_amount,
)
from ..schema import KEY, VELOCITY, conform


def enrich(
    transactions: DataFrame,
    rates: DataFrame,
    fx: str = "divide",
    string_rule: bool = False,
    with_id_only: bool = False,
    spread: int | None = None,
    forget_after: str | None = None,
) -> DataFrame:
    """De-duplicate, date, convert and conform typed transactions; batch or stream.

    ``with_id_only`` leaves out rows without an id, which a keyed table refuses, and
    blank ids, before they reach any state; ``rejected_json`` and ``rejected_csv``
    give their payloads. ``spread`` splits hot ids of a stream, as
    ``drop_repeated_ids_spread`` does, and ``forget_after`` bounds a stream's state,
    as ``drop_repeated_ids_within`` does; batch needs neither.
    """
    rows = transactions.drop(VELOCITY)
    if with_id_only:
        rows = rows.where(has_id(F.col(KEY)))
    if spread and forget_after:
        raise ValueError("choose spread or forget_after")
    if forget_after and rows.isStreaming:
        unique = drop_repeated_ids_within(rows, forget_after)
    elif spread and rows.isStreaming:
        unique = drop_repeated_ids_spread(rows, spread=spread)
    else:
        unique = drop_repeated_ids(rows)
    dated = add_calendar(unique, string_rule=string_rule)
    return conform(usd_amount(dated, rates, fx))


def enrich_json(
    payloads: DataFrame,
    rates: DataFrame,
    fx: str = "multiply",
    strict: bool = False,
    **options,
) -> DataFrame:
    """JSON payloads in ``value`` to target rows. This path multiplies by the rate."""
    return enrich(parse_json(payload_to_string(payloads), strict=strict), rates, fx, **options)


def enrich_csv(
    payloads: DataFrame,
    rates: DataFrame,
    fx: str = "divide",
    unquote: bool = False,
    **options,
) -> DataFrame:
    """CSV lines in ``value`` to target rows. This path divides by the rate."""
    fields = cast_fields(parse_csv_line(payload_to_string(payloads), unquote=unquote))
    return enrich(fields, rates, fx, **options)
