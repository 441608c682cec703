"""A table whose micro-batches count once: each is a folder, named by a record of its writer.

A batch is written to a folder of its own, which no reader sees until a record of writer and
batch number names it. The record is put in place by one rename, so a batch is there whole or
not at all. A batch delivered again writes another folder and replaces its own record; the
rows it wrote before drop out with the old one. No stored id is read for that, and the
record is on shared storage, so it holds for a new process too.

Several writers may share a table; each has its own batch numbers. A writer's number sequence
is its checkpoint's, so a new checkpoint needs a new writer name.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TARGET, conform, ddl
from ..session import list_names, path_exists, replace_file
from .ids import require_ids
from .parquet import write_partitioned

RECORD = "writer string, batch long, since long, folder string"


def _folder(writer: str, batch_id: int) -> str:
    return f"writer={writer}/batch={batch_id}-{uuid.uuid4().hex}"


def _put(spark: SparkSession, path: str, writer: str, batch_id: int, since: int, folder: str) -> None:
    record = {"writer": writer, "batch": batch_id, "since": since, "folder": folder}
    replace_file(spark, f"{path}/_commits/{writer}-{batch_id:020d}.json", json.dumps(record))


def commit_batch(batch: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Make ``batch`` the rows of ``writer``'s batch ``batch_id``, whatever they were before."""
    folder = _folder(writer, batch_id)
    write_partitioned(require_ids(conform(batch)), f"{path}/{folder}")
    _put(batch.sparkSession, path, writer, batch_id, batch_id, folder)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """writer, batch, since and folder of the records that count.

    A record stands for its writer's batches from ``since`` to ``batch``.
    """
    if not path_exists(spark, f"{path}/_commits"):
        return spark.createDataFrame([], RECORD)
    found = spark.read.schema(RECORD).json(f"{path}/_commits")
    wider = found.where("since < batch").select(
        F.col("writer").alias("w"), F.col("since").alias("low"), F.col("batch").alias("high")
    )
    inside = (F.col("writer") == F.col("w")) & (F.col("batch") >= F.col("low"))
    inside &= F.col("batch") < F.col("high")
    return found.join(wider, inside, "left_anti")


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that count, columns in contract order; dates prune folders."""
    folders = [row["folder"] for row in commits(spark, path).select("folder").collect()]
    return _read(spark, path, folders)


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], ddl(TARGET))
    reader = spark.read.schema(f"{ddl(TARGET)}, writer string, batch string")
    return conform(reader.option("basePath", path).parquet(*(f"{path}/{f}" for f in folders)))


def compact(spark: SparkSession, path: str, writer: str) -> int | None:
    """Write all of a writer's batches but its last as one, in larger files; the last such batch.

    The last batch may be delivered again, so it stays apart. One record takes the place of
    the others; folders that no record names any more can be removed once no reader is left.
    """
    mine = commits(spark, path).where(F.col("writer") == writer)
    rows = sorted((row["batch"], row["since"], row["folder"]) for row in mine.collect())[:-1]
    if len(rows) < 2:
        return None
    last, since = rows[-1][0], rows[0][1]
    folder = _folder(writer, last)
    together = _read(spark, path, [f for _, _, f in rows])
    write_partitioned(together, f"{path}/{folder}")
    _put(spark, path, writer, last, since, folder)
    return last


def unlisted(spark: SparkSession, path: str) -> list[str]:
    """Folders of batches that no record names: replaced, compacted or never committed."""
    named = {row["folder"] for row in commits(spark, path).select("folder").collect()}
    found = [
        f"{writer}/{batch}"
        for writer in list_names(spark, path)
        if writer.startswith("writer=")
        for batch in list_names(spark, f"{path}/{writer}")
    ]
    return sorted(set(found) - named)
