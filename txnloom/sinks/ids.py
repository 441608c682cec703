"""Which rows of a batch a keyed table still lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEY

MAX_BROADCAST_IDS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    ids: DataFrame, key: str = KEY, max_rows: int = MAX_BROADCAST_IDS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Whether the ids are few and short enough to send to every executor."""
    size = ids.agg(
        F.count("*").alias("rows"), F.sum(F.octet_length(key)).alias("bytes")
    ).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def keep_unseen(
    batch: DataFrame, existing: DataFrame, key: str = KEY,
    max_rows: int = MAX_BROADCAST_IDS, max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``batch`` whose id is not in ``existing``.

    The table is far larger than a batch, so the batch's ids go to the table: it
    is scanned for its id column only and does not shuffle. A batch past the
    broadcast bound shuffles both sides on the id instead. ``batch`` is read more
    than once; persist it.
    """
    ids, known = batch.select(key), existing.select(key)
    if fits_broadcast(ids, key, max_rows, max_bytes):
        # At most the batch's own ids, hence within the same bound.
        known = F.broadcast(known.join(F.broadcast(ids), key, "left_semi").distinct())
    return batch.join(known, key, "left_anti")


def require_ids(batch: DataFrame, key: str = KEY, carrier: str = "rate_usd") -> DataFrame:
    """Fail the write if a row has no id, as a primary key does.

    The check rides on another computed column. On the id itself it would undo
    the partitioning by id, and as a filter it would be pushed down to the
    payload and decode that twice.
    """
    failure = F.raise_error(F.lit(f"{key} is null")).cast(batch.schema[carrier].dataType)
    return batch.withColumn(
        carrier, F.when(F.col(key).isNull(), failure).otherwise(F.col(carrier))
    )
