"""Places of lines in text files that many tasks read, and records that span lines.

A scan gives each line the split it came from (file and first byte) and an ascending number
within the task. One pass counts lines and quotes by split. That index has one row for each
split, a hundred megabytes or so of input, and running sums over it give the number of every
line, and whether a split starts inside quotes, without moving the lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..session import input_files, scratch_path

#: Splits whose index rows are sent to every task; beyond, lines are shuffled by split.
MAX_BROADCAST_SPLITS = 1_000_000

_SPLIT = ["file", "start"]


def split_lines(lines: DataFrame) -> DataFrame:
    """``value`` of a text reader with ``path``, ``file`` (its hash), ``start`` and ``row``."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def quotes(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def split_index(lines: DataFrame) -> DataFrame:
    """A row for each split, counted into the scratch folder: what comes before, where it breaks.

    ``before`` and ``quoted`` are the lines and whether quotes are open ahead of it in its file,
    ``file_before`` the lines of earlier files by path, ``first_row`` its least row, and
    ``first_odd`` and ``last_odd`` the rows with an odd number of quotes, which open or close
    a record.
    """
    odd = F.when(quotes(F.col("value")) % 2 == 1, F.col("row"))
    counts = lines.groupBy("path", *_SPLIT).agg(
        F.count("*").alias("lines"),
        F.count(odd).alias("odd"),
        F.min("row").alias("first_row"),
        F.min(odd).alias("first_odd"),
        F.max(odd).alias("last_odd"),
    )
    spark = lines.sparkSession
    path = scratch_path(spark, "splits")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sooner = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = counts.groupBy("path").agg(F.sum("lines").alias("in_file"))
    files = files.select(
        "path", F.coalesce(F.sum("in_file").over(sooner), F.lit(0)).alias("file_before")
    )
    index = counts.withColumns(
        {
            "before": F.coalesce(F.sum("lines").over(earlier), F.lit(0)),
            "quoted": F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1,
        }
    )
    index = index.withColumn("open_at_end", F.col("quoted") != (F.col("odd") % 2 == 1))
    return index.join(files, "path").drop("path", "lines", "odd")


def with_index(
    lines: DataFrame, index: DataFrame, *columns: str, most: int = MAX_BROADCAST_SPLITS
) -> DataFrame:
    """``lines`` with ``columns`` of their split, in order within each task's splits.

    A split that the index lacks, because the files or the size of splits changed since,
    fails the job.
    """
    known = index.select(*_SPLIT, *columns, F.lit(True).alias("_known"))
    few = index.count() <= most
    placed = lines.join(F.broadcast(known) if few else known.hint("merge"), _SPLIT, "left")
    if not few:
        placed = placed.sortWithinPartitions(*_SPLIT, "row")
    lost = F.raise_error(F.lit("files or splits changed after they were counted"))
    checked = F.when(F.col("_known"), F.col("value")).otherwise(lost.cast("string"))
    return placed.withColumn("value", checked).drop("_known")


@F.pandas_udf(BooleanType())
def _opens_file(splits: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether a row is the first of a file's first split; the rows of a split come together."""
    before = (None, None)
    for files, starts in splits:
        file, start = files.to_numpy(), starts.to_numpy()
        fresh = np.ones(len(file), bool)
        fresh[1:] = (file[1:] != file[:-1]) | (start[1:] != start[:-1])
        if len(file):
            fresh[0] = (file[0], start[0]) != before
            before = (file[-1], start[-1])
        yield pd.Series(fresh & (start == 0))


def without_first_lines(lines: DataFrame) -> DataFrame:
    """``value`` of all lines but the first of each file, whatever it holds; batch or stream.

    Only the places of lines go through Python, not the lines.
    """
    placed = lines.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    # it depends on the rows before, so no filter may go ahead of it
    opens = _opens_file.asNondeterministic()
    return placed.withColumn("opens", opens("file", "start")).where("not opens").select("value")


def first_rows(
    spark: SparkSession, path: str, rows: int, read: Callable[[list[str]], DataFrame]
) -> DataFrame:
    """The first ``rows`` rows by ``position`` of what ``read`` makes of files.

    Files are taken in order of path, until they hold enough; further ones are not read.
    """
    files = input_files(spark, path)
    take = 1
    while take < len(files) and read(files[:take]).limit(rows).count() < rows:
        take *= 4
    return read(files[:take]).orderBy("position").limit(rows)


def _numbered(lines: DataFrame, index: DataFrame, most: int) -> DataFrame:
    """``lines`` with the columns of their split, ``in_file`` and ``position``."""
    columns = ("before", "file_before", "first_row", "quoted", "open_at_end", "first_odd", "last_odd")
    placed = with_index(lines, index, *columns, most=most)
    in_file = F.col("row") - F.col("first_row") + F.col("before")
    return placed.withColumns({"in_file": in_file, "position": in_file + F.col("file_before")})


def numbered_lines(
    spark: SparkSession, paths: str | list[str], most: int = MAX_BROADCAST_SPLITS
) -> DataFrame:
    """``value``, ``in_file`` (the line's number in its file, from 0) and ``position`` over all files.

    Files are in order of path.
    """
    lines = split_lines(spark.read.text(paths))
    return _numbered(lines, split_index(lines), most).select("value", "in_file", "position")


RECORD = "value string, in_file long, position long"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of lines in order, each numbered by its first line.

    A record starts at a line before which quotes are closed. Lines of records that span
    splits are left out beforehand, so quotes are closed at the first line.
    """
    names = ["value", "in_file", "position"]
    held: list[str] = []
    place: list[int] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(0)
        odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2 == 1
        closed_after = np.cumsum(odd) % 2 == (1 if held else 0)
        closed_before = np.concatenate([[not held], closed_after[:-1]])
        single = closed_before & ~odd
        yield batch.filter(pa.array(single))
        out: list[tuple] = []
        for i in np.flatnonzero(~single).tolist():
            if closed_before[i]:
                place = [column[i].as_py() for column in batch.columns[1:]]
            held.append(values[i].as_py())
            if closed_after[i]:
                out.append(("\n".join(held), *place))
                held = []
        if out:
            columns = [pa.array(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def quoted_records(
    spark: SparkSession, paths: str | list[str], most: int = MAX_BROADCAST_SPLITS
) -> DataFrame:
    """Records of CSV files, line breaks inside quotes kept, with the numbers of their first line.

    Files are split between tasks. Any line break, inside quotes too, comes out as a line
    feed. Each quote opens or closes; a record left open ends with its file. Only the lines
    of records that span splits are shuffled, by the split in which the record starts.
    """
    lines = split_lines(spark.read.text(paths))
    index = split_index(lines)
    placed = _numbered(lines, index, most)
    # up to the line that closes what came in open, and from the line that opens what goes on
    tail = F.col("quoted") & (F.col("row") <= F.coalesce("first_odd", F.col("row")))
    head = F.col("open_at_end") & (F.col("row") >= F.coalesce("last_odd", F.col("row")))
    inner = placed.where(~tail & ~head).select("value", "in_file", "position")
    whole = inner.mapInArrow(_records, RECORD)
    if index.where("quoted or open_at_end").isEmpty():
        return whole
    pieces = placed.where(tail | head).withColumn("head", head)
    return whole.union(_stitched(pieces, index))


def _stitched(pieces: DataFrame, index: DataFrame) -> DataFrame:
    """The records that span splits, from their lines at the end of a split and the start of others."""
    along = Window.partitionBy("file").orderBy("start")
    opens = F.col("open_at_end") & (~F.col("quoted") | F.col("first_odd").isNotNull())
    spans = index.withColumn("opens", opens.cast("int")).select(
        *_SPLIT, F.sum("opens").over(along).alias("opened"), "opens"
    )
    record = F.when(F.col("head"), F.col("opened")).otherwise(F.col("opened") - F.col("opens"))
    owned = pieces.select("value", "in_file", "position", "head", *_SPLIT).join(spans, _SPLIT)
    parts = F.sort_array(F.collect_list(F.struct("position", "value"))).alias("parts")
    joined = owned.groupBy("file", record.alias("record")).agg(
        parts, F.min("in_file").alias("in_file"), F.min("position").alias("position")
    )
    return joined.select(F.array_join(F.col("parts.value"), "\n").alias("value"), "in_file", "position")
