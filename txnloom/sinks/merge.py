"""A table that holds, of each id, the row that comes first by event time, whenever it arrives."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import keep_first
from ..schema import EVENT_TIME, KEY, PARTITION_COLUMNS
from ..session import path_exists, remove_folder, scratch_path
from .ids import fits_broadcast


def merge_first(
    batch: DataFrame,
    path: str,
    key: str = KEY,
    order_by: tuple[str, ...] = (EVENT_TIME,),
    parts: tuple[str, ...] = PARTITION_COLUMNS,
) -> None:
    """Take ``batch`` into the table so that it holds what ``keep_first`` keeps of all batches.

    ``parts`` are the table's folders, by columns of the batch. The table is its own state:
    its ids are scanned for those of the batch, and only folders that lose a row are
    written anew; rows for other folders are appended. The new rows go in before old ones
    go out, so a batch that fails half-way loses nothing, and delivered again it ends where
    it would have. Null ids count as one id.
    """
    spark = batch.sparkSession
    if not path_exists(spark, path):
        _write(keep_first(batch, key, order_by), path, "append", parts)
        return
    batch = keep_first(batch, key, order_by).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        table = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
        ids = batch.select(F.col(key).alias("_id"))
        of_batch = F.col(key).eqNullSafe(F.col("_id"))
        sent = F.broadcast(ids) if fits_broadcast(ids, "_id") else ids
        # of equal rows the stored one counts as first: the mark is the last column
        stored = table.join(sent, of_batch, "left_semi").withColumn("_new", F.lit(False))
        both = stored.unionByName(batch.withColumn("_new", F.lit(True)))
        place = scratch_path(spark, "winners")
        keep_first(both, key, order_by).write.parquet(place)
        winners = spark.read.schema(both.schema).parquet(place)
        # folders whose stored rows are not all winners
        counts = stored.groupBy(*parts).agg(F.count("*").alias("held"))
        staying = winners.where("not _new").groupBy(*parts).agg(F.count("*").alias("stay"))
        same = [counts[p].eqNullSafe(staying[p]) for p in parts]
        touched = counts.join(staying, same, "left").where("stay is null or stay < held")
        touched = touched.select(*(counts[p] for p in parts)).collect()
        fresh = winners.where("_new").drop("_new")
        here = _among(touched, parts)
        _write(fresh.where(~here), path, "append", parts)
        if touched:
            others = table.where(here).join(sent, of_batch, "left_anti")
            anew = others.unionByName(winners.where(here).drop("_new"))
            place = scratch_path(spark, "anew")
            anew.write.parquet(place)
            anew = spark.read.schema(anew.schema).parquet(place)
            filled = {tuple(row) for row in anew.select(*parts).distinct().collect()}
            _write(anew, path, "overwrite", parts)
            for row in touched:
                if tuple(row) not in filled:
                    names = "/".join(f"{p}={_folder(row[p])}" for p in parts)
                    remove_folder(spark, f"{path}/{names}")
    finally:
        batch.unpersist()


def _folder(value: object) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def _among(rows: list, parts: tuple[str, ...]):
    """Whether a row's folder is one of ``rows``; never null."""
    found = F.lit(False)
    if rows:
        # one list for the folders: their number is that of dates, not of rows
        place = F.concat_ws("/", *(F.coalesce(F.col(p).cast("string"), F.lit("-")) for p in parts))
        names = ["/".join("-" if row[p] is None else str(row[p]) for p in parts) for row in rows]
        found = place.isin(names)
    return found


def _write(df: DataFrame, path: str, mode: str, parts: tuple[str, ...]) -> None:
    names = ", ".join(parts)
    placed = df.sparkSession.sql(f"SELECT /*+ REBALANCE({names}) */ * FROM {{rows}}", rows=df)
    writer = placed.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)
