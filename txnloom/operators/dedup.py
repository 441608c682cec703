"""Removal of repeated transaction ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import to_instant
from ..schema import EVENT_TIME, KEY


def drop_repeated_ids(df: DataFrame, key: str = KEY) -> DataFrame:
    """Keep one whole row per id; null ids count as one id.

    On a stream the first arrival stays and its id is remembered for good. In
    batch the survivor is the earliest row by ``keep_first``, the same on every run.
    """
    if df.isStreaming:
        return df.dropDuplicates([key])
    return keep_first(df, key)


def keep_first(
    df: DataFrame, key: str = KEY, order_by: tuple[str, ...] = (EVENT_TIME,)
) -> DataFrame:
    """The least row per id by ``order_by``, ties broken by the remaining columns.

    Event times are compared as instants, whatever their text; one that is missing
    or can't be read comes after all others.

    A rank filter of one lets Spark prune each id to one row per input task before
    the shuffle, so an id with a third of all rows sends one row per task.
    """
    orderable = [name for name, kind in df.dtypes if "map<" not in kind and name != key]
    lead = [name for name in order_by if name in orderable]
    kinds = dict(df.dtypes)
    instant = [to_instant(F.col(n)) if kinds[n] == "string" else F.col(n) for n in lead]
    ordering = [time.asc_nulls_last() for time in instant] + orderable
    first = Window.partitionBy(key).orderBy(*(ordering or [key]))
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def drop_repeated_ids_within(df: DataFrame, delay: str, key: str = KEY) -> DataFrame:
    """Stream form with bounded state: an id is forgotten ``delay`` after it arrived.

    A repeat that comes later than that is kept. Arrival is the micro-batch's clock,
    not the event time, so a row of whatever time, or none, is never late. ``delay``
    must exceed any step back of the driver's clock.
    """
    marked = df.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", delay)
    return marked.dropDuplicatesWithinWatermark([key]).drop("_seen")


def drop_repeated_ids_spread(df: DataFrame, key: str = KEY, spread: int = 16) -> DataFrame:
    """Stream form for hot ids: two stages, the first over ``(id, slot)``.

    A stream has no pre-shuffle combine, so every copy of an id goes to one task.
    Here copies first meet in ``spread`` slots taken from the input task number,
    and only what is new to a slot goes on. Neither stage forgets, so no row can be
    lost. It costs one more shuffle and as much state again, or up to ``spread``
    times for an id that comes that often.
    """
    slot = F.pmod(F.spark_partition_id(), F.lit(spread))
    placed = df.withColumn("_slot", slot).dropDuplicates([key, "_slot"])
    return placed.drop("_slot").dropDuplicates([key])
