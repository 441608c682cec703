"""A table bucketed by id, so that looking for stored ids neither moves nor broadcasts it.

Its files are cut by a hash of the id into a fixed number of buckets. A batch placed by the
same hash meets each bucket in one task, however large the table. Every batch of every writer
is a folder and a partition of its own: batches of several writers never touch each other's
files, and a batch delivered again overwrites what it wrote before.

Two writers that append at the same moment can't see each other's ids, so an id may be stored
twice. ``unique_rows`` reads one row for each id; that needs no shuffle either.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keep_first
from ..schema import CALENDAR, KEY, TARGET, TARGET_NAMES, conform, ddl
from ..session import path_exists
from .ids import require_ids


@dataclass(frozen=True)
class BucketedTable:
    """Where the table is and its number of buckets, which is fixed when it is first written."""

    name: str
    path: str
    buckets: int

    def _create(self, name: str, path: str, columns: str, parts: str = "") -> str:
        return (
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def open(self, spark: SparkSession) -> DataFrame:
        """All rows with writer and batch; declares the table and finds its folders anew."""
        columns = f"{ddl(TARGET)}, writer string, batch bigint"
        spark.sql(self._create(self.name, self.path, columns, "PARTITIONED BY (writer, batch)"))
        if path_exists(spark, self.path):
            spark.catalog.recoverPartitions(self.name)
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def append_new(
        self, batch: DataFrame, writer: str, batch_id: int, stored: DataFrame | None = None
    ) -> None:
        """Store the rows whose id no other batch has; ids must be distinct in the batch.

        A null id fails the append. Delivered again, the batch replaces what it wrote.
        ``stored`` is what the writer saw of the table, if that is not what it holds now.
        """
        spark = batch.sparkSession
        held = self.open(spark)
        stored = held if stored is None else stored
        folder = f"{self.path}/writer={writer}/batch={batch_id}"
        part = f"{self.name}_part_{uuid.uuid4().hex}"
        spark.sql(self._create(part, folder, ddl(TARGET)))
        try:
            self.unseen(batch, stored, writer, batch_id).write.insertInto(part, overwrite=True)
        finally:
            spark.sql(f"DROP TABLE {part}")  # its files stay
        spark.sql(
            f"ALTER TABLE {self.name} ADD IF NOT EXISTS "
            f"PARTITION (writer = '{writer}', batch = {batch_id})"
        )

    def unseen(self, batch: DataFrame, stored: DataFrame, writer: str, batch_id: int) -> DataFrame:
        rows = require_ids(conform(batch)).repartition(self.buckets, KEY)
        others = stored.where((F.col("writer") != writer) | (F.col("batch") != batch_id))
        return rows.join(others.select(KEY).hint("merge"), KEY, "left_anti").select(*TARGET_NAMES)

    def unique_rows(self, spark: SparkSession) -> DataFrame:
        """One row for each id: the earliest by date and time, then by the other columns."""
        return keep_first(conform(self.open(spark)), KEY, CALENDAR)
