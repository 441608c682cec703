"""Date-partitioned Parquet tables laid out for lookups by id and date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators import drop_repeated_ids
from ..schema import KEY, PARTITION_COLUMNS, TARGET, conform, ddl
from ..session import path_exists
from .ids import keep_unseen, require_ids


def write_partitioned(
    df: DataFrame, path: str, mode: str = "append", ranges: int | None = None, disjoint: bool = False
) -> None:
    """Write folders by year, month and day, rows sorted by id, with a Bloom filter on the id.

    Rows are placed by date, and adaptive execution splits a heavy day over many tasks and
    merges light ones by the sizes that the shuffle wrote, so nothing is sampled or read
    twice. A lookup by id skips the row groups whose filter lacks it, wherever they are;
    filters are sized by the distinct ids that each row group turns out to hold.

    ``disjoint`` instead gives each file its own range of ids within a date, for lookups by
    bounds; that samples the rows first. ``ranges`` fixes the number of those ranges.
    """
    order = [*PARTITION_COLUMNS, KEY]
    if disjoint or ranges:
        placed = df.repartitionByRange(*([ranges] if ranges else []), *order)
    else:
        dates = ", ".join(PARTITION_COLUMNS)
        placed = df.sparkSession.sql(f"SELECT /*+ REBALANCE({dates}) */ * FROM {{rows}}", rows=df)
    (
        placed.sortWithinPartitions(*order)
        .write.mode(mode)
        .option(f"parquet.bloom.filter.enabled#{KEY}", True)
        .option("parquet.bloom.filter.adaptive.enabled", True)
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The target table with its declared schema, columns in contract order."""
    return conform(spark.read.schema(ddl(TARGET)).parquet(path))


def append_new(
    batch: DataFrame,
    path: str,
    unique: bool = False,
    check_existing: bool = True,
    bulk: bool = False,
    ranges: int | None = None,
) -> None:
    """Append the rows whose id the table lacks, so a repeated append adds nothing.

    Set ``unique`` if ids are already distinct within the batch, and unset
    ``check_existing`` if none of them can be in the table yet. A null id fails
    the append. A batch is cached while its ids are looked up in the table;
    ``bulk`` is for loads too large for that: the table's ids are shuffled to
    join the rows, which de-duplication has already put in place by id.
    """
    spark = batch.sparkSession
    rows = require_ids(conform(batch if unique else drop_repeated_ids(batch)))
    if not check_existing or not path_exists(spark, path):
        write_partitioned(rows, path, ranges=ranges)
        return
    table = read_table(spark, path)
    if bulk:
        unseen = rows.join(table.select(KEY), KEY, "left_anti")
        write_partitioned(unseen, path, ranges=ranges)
        return
    # The lookup reads the rows several times; a cached batch needs no second copy.
    own_copy = not (unique and batch.is_cached)
    if own_copy:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_partitioned(keep_unseen(rows, table), path, ranges=ranges)
    finally:
        if own_copy:
            rows.unpersist()


def lookup(
    spark: SparkSession, path: str, year: int | None = None, month: int | None = None,
    day: int | None = None, transaction_id: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rows by date and id, or by either; dates prune folders, ids prune row groups."""
    found = read_table(spark, path)
    if transaction_id is not None and not isinstance(transaction_id, str):
        found = found.where(found[KEY].isin(*transaction_id))
        transaction_id = None
    wanted = {"year": year, "month": month, "day": day, KEY: transaction_id}
    for name, value in wanted.items():
        if value is not None:
            found = found.where(found[name] == value)
    return found


def create_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Declare the 28-column target table in the catalog unless it is there already."""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl(TARGET)}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}){location}"
    )
