"""CSV, text, message and Parquet files, as batch or streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schema import FIELD_NAMES, all_string_ddl
from ..session import is_directory
from .lines import first_rows, numbered_lines, quoted_records, without_first_lines


def _reader(
    spark: SparkSession,
    streaming: bool,
    max_files_per_trigger: int | None,
    max_bytes_per_trigger: int | None = None,
):
    """A reader; a stream's takes files up to one of the limits at a time, but at least one."""
    if not streaming:
        return spark.read
    reader = spark.readStream
    if max_files_per_trigger is not None and max_bytes_per_trigger is not None:
        raise ValueError("limit a stream by files or by bytes")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader


def csv_rows(
    spark: SparkSession,
    path: str,
    names: tuple[str, ...] = FIELD_NAMES,
    streaming: bool = False,
    multiline: bool = False,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    first: int | None = None,
) -> DataFrame:
    """CSV files with a header, every field as text, doubled quotes inside quotes.

    A header that differs from ``names`` fails the read. Empty fields are empty
    text. Files are split between tasks. ``multiline`` allows line breaks inside
    quotes, which come out as line feeds; a stream then reads each file in one
    task. ``first`` gives only so many rows of a batch, in order of path and place.
    """
    if not streaming and (multiline or first is not None):
        return _csv_records(spark, path, names, first)
    rows = (
        _reader(spark, streaming, max_files_per_trigger, max_bytes_per_trigger)
        .schema(all_string_ddl(names))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    return rows.select(*(F.coalesce(F.col(n), F.lit("")).alias(n) for n in names))


def _csv_records(
    spark: SparkSession, path: str, names: tuple[str, ...], first: int | None
) -> DataFrame:
    """Rows of records found by their place, without each file's first record, its header."""
    header = F.lit(",".join(names))
    heads = F.col("in_file") == 0
    wrong = F.raise_error(F.concat(F.lit("not the declared header: "), F.col("value")))

    def read(paths: str | list[str]) -> DataFrame:
        records = quoted_records(spark, paths).where(heads | (F.col("value") != ""))
        shown = F.when(heads & (F.col("value") != header), wrong.cast("string"))
        return records.withColumn("value", F.coalesce(shown, "value")).where(
            ~heads | (F.col("value") != header)
        )

    rows = read(path) if first is None else first_rows(spark, path, first, read)
    options = {"escape": '"', "multiLine": "true"}
    fields = rows.select(F.from_csv("value", all_string_ddl(names), options).alias("fields"))
    return fields.select(*(F.coalesce(F.col("fields")[n], F.lit("")).alias(n) for n in names))


def text_lines(
    spark: SparkSession,
    path: str,
    header: bool = True,
    keep_blank: bool = False,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    first: int | None = None,
) -> DataFrame:
    """Raw lines in ``value``, stripped, without blank lines and each file's first line.

    The first line is known by its place, so files may differ in it, a later line
    may equal it and it may be blank. ``header=False`` keeps every line, and
    ``keep_blank`` blank ones. ``first`` gives only so many of the lines of a batch
    that are kept, in order of path and place.
    """
    if first is not None:
        if streaming:
            raise ValueError("a number of first lines needs a batch")

        def read(paths: list[str]) -> DataFrame:
            numbered = numbered_lines(spark, paths)
            if header:
                numbered = numbered.where("in_file > 0")
            return _kept(numbered, keep_blank, "position")

        return first_rows(spark, path, first, read).select("value")
    lines = _reader(spark, streaming, max_files_per_trigger, max_bytes_per_trigger).text(path)
    return _kept(without_first_lines(lines) if header else lines, keep_blank)


def _kept(lines: DataFrame, keep_blank: bool, *columns: str) -> DataFrame:
    stripped = lines.select(strip(F.col("value")).alias("value"), *columns)
    return stripped if keep_blank else stripped.where(F.col("value") != "")


def parquet_rows(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A Parquet file or folder of files. A stream takes its schema from the data if not given."""
    if not streaming:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    reader = _reader(spark, True, max_files_per_trigger, max_bytes_per_trigger)
    reader = reader.schema(schema or spark.read.parquet(path).schema)
    if is_directory(spark, path):
        return reader.parquet(path)
    # A file stream watches a folder, so a single file is picked out by name.
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder or ".")
