"""Append to a table behind JDBC."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..schema import KEY, PARTITION_COLUMNS, TARGET, conform
from ..sources.jdbc import JdbcTarget, hash_parts, jdbc_query
from .ids import keep_unseen, require_ids


# Column types and index name of the target table in PostgreSQL.
SQL_TYPES = {"string": "TEXT", "double": "FLOAT", "boolean": "BOOLEAN", "int": "INT"}
DATE_INDEX = "idx_transaction_date"


def table_statements(table: str) -> tuple[str, str]:
    """SQL that creates the keyed table and its lookup index unless they exist."""
    columns = ", ".join(
        f"{name} {SQL_TYPES[kind]}{' PRIMARY KEY' if name == KEY else ''}" for name, kind in TARGET
    )
    indexed = ", ".join((KEY, *PARTITION_COLUMNS))
    return (
        f"CREATE TABLE IF NOT EXISTS {table} ({columns})",
        f"CREATE INDEX IF NOT EXISTS {DATE_INDEX} ON {table} ({indexed})",
    )


def create_table_jdbc(spark: SparkSession, target: JdbcTarget) -> None:
    """Create the target table in the database unless it is there already.

    Spark's own table creation knows no keys, so each statement runs when the
    session of a one-row read opens.
    """
    for statement in table_statements(target.table):
        (
            spark.read.option("sessionInitStatement", statement)
            .jdbc(target.url, "(SELECT 1 AS ready) AS q", properties=target.properties)
            .collect()
        )


def append_jdbc(
    batch: DataFrame, target: JdbcTarget, max_connections: int = 16, batch_size: int = 5000
) -> None:
    """Insert rows by column name, over at most ``max_connections`` connections."""
    batch.write.option("numPartitions", max_connections).option("batchsize", batch_size).jdbc(
        target.url, target.table, mode="append", properties=target.properties
    )


def stored_ids(
    batch: DataFrame, target: JdbcTarget, max_connections: int = 16, writer: str | None = None
) -> DataFrame:
    """The batch's ids that the table already holds, read over several connections.

    The ids are put in a side table and joined inside the database, so the work
    follows the batch and the table's key index, not the size of the table. The
    side table is replaced each time; jobs that append at the same time need names of
    their own, as ``writer``. Should both insert one id, the key fails one batch, which
    finds the id stored when it is delivered again.
    """
    side = f"{target.table}_incoming" + (f"_{writer}" if writer else "")
    (
        batch.select(KEY)
        .write.option("numPartitions", max_connections)
        .option("truncate", True)
        .jdbc(target.url, side, mode="overwrite", properties=target.properties)
    )
    query = f"SELECT t.{KEY} FROM {target.table} t JOIN {side} s ON t.{KEY} = s.{KEY}"
    parts = hash_parts(KEY, max_connections)
    return jdbc_query(batch.sparkSession, target, query, parts)


def append_new_jdbc(
    batch: DataFrame,
    target: JdbcTarget,
    check_existing: bool = True,
    max_connections: int = 16,
    writer: str | None = None,
) -> None:
    """Insert the rows whose id the table lacks; ids must be distinct in the batch.

    A batch that failed part-way may have left rows behind, and inserting those
    again would break the primary key.
    """
    rows = require_ids(conform(batch))
    if not check_existing:
        append_jdbc(rows, target, max_connections)
        return
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = stored_ids(rows, target, max_connections, writer)
        append_jdbc(keep_unseen(rows, known), target, max_connections)
    finally:
        rows.unpersist()
