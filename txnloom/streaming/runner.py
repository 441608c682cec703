"""Starting streaming queries. Every start needs a checkpoint location."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators import FX_MODES, usd_amount
from ..schema import EVENT_TIME, KEY, PARTITION_COLUMNS, conform
from ..session import (
    has_class,
    make_folder,
    on_local_disk,
    path_exists,
    remove_file,
    replace_file,
)
from ..sinks import (
    BucketedTable,
    append_new,
    append_new_jdbc,
    commit_batch,
    kafka_write_options,
    merge_first,
)
from ..sources import JdbcTarget, RateBook, parquet_rows

BatchSink = Callable[[DataFrame, int], None]


def _writer(df: DataFrame, checkpoint: str, every: str | None, drain: bool) -> DataStreamWriter:
    """Append mode. ``every`` paces micro-batches; ``drain`` stops at the end of the input."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


_LOG_WRITER = "spark.sql.streaming.checkpointFileManagerClass"
_STREAMING = "org.apache.spark.sql.execution.streaming"
# since Spark 4.1, and before
_PLAIN_LOG_WRITERS = tuple(
    f"{_STREAMING}.{name}FileSystemBasedCheckpointFileManager" for name in ("checkpointing.", "")
)


@contextmanager
def plain_logs(spark: SparkSession, place: str) -> Iterator[None]:
    """On a local disk, streams that run in it write their logs by Hadoop's older interface.

    Both write a hidden file and rename it once they see no file of its name. The newer one
    starts more processes there, for links and owners, some for every micro-batch. Nothing
    changes where ``place`` is not on a local disk or the session names a way itself.
    """
    plain = None
    if spark.conf.get(_LOG_WRITER, None) is None and on_local_disk(spark, place):
        plain = next((name for name in _PLAIN_LOG_WRITERS if has_class(spark, name)), None)
    if plain is not None:
        spark.conf.set(_LOG_WRITER, plain)
    try:
        yield
    finally:
        if plain is not None:
            spark.conf.unset(_LOG_WRITER)


def start_batches(
    df: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    every: str | None = None,
    drain: bool = False,
    marker: str | None = None,
) -> StreamingQuery:
    """Call ``sink(batch, batch_id)`` for each micro-batch.

    Once the file ``marker`` is there, the next micro-batch ends the query before the sink
    sees it. It was not committed, so the next run starts with it.
    """
    return _writer(df, checkpoint, every, drain).foreachBatch(_until(sink, marker)).start()


_STOPPED = "stopped on request by the marker"


def _until(sink: BatchSink, marker: str | None) -> BatchSink:
    if marker is None:
        return sink

    def guarded(batch: DataFrame, batch_id: int) -> None:
        if path_exists(batch.sparkSession, marker):
            raise InterruptedError(f"{_STOPPED} {marker}")
        sink(batch, batch_id)

    return guarded


def request_stop(spark: SparkSession, marker: str) -> None:
    """Ask the queries that were started with ``marker``, of any process, to stop."""
    replace_file(spark, marker, "stop\n")


def withdraw_stop(spark: SparkSession, marker: str) -> None:
    remove_file(spark, marker)


def _checking(append: Callable[[DataFrame, bool], None], sole_writer: bool) -> BatchSink:
    """A batch sink that tells ``append`` whether to look for stored ids.

    It looks in every batch, unless the checkpoint is the table's ``sole_writer``,
    that is, the table holds nothing but what this checkpoint wrote. Ids are then
    distinct over all batches, and only the batch that was in flight when the last
    run ended can be delivered again. It does not follow the batch that was last
    attempted, so a batch is checked unless its number is the next one.
    """
    last: int | None = None

    def sink(batch: DataFrame, batch_id: int) -> None:
        nonlocal last
        follows = last is not None and batch_id == last + 1
        last = batch_id  # before the attempt: one that fails may have written
        append(batch, not (sole_writer and follows))

    return sink


def parquet_sink(path: str, sole_writer: bool = False, ranges: int | None = None) -> BatchSink:
    """Append micro-batches of distinct ids to a date-partitioned table.

    A check scans the table's id column, so set ``sole_writer`` where it holds.
    """

    def append(batch: DataFrame, check: bool) -> None:
        # Ranging samples its input first; uncached, that would run the state store twice.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            append_new(batch, path, unique=True, check_existing=check, ranges=ranges)
        finally:
            batch.unpersist()

    return _checking(append, sole_writer)


def jdbc_sink(
    target: JdbcTarget, sole_writer: bool = False, writer: str | None = None
) -> BatchSink:
    """Append micro-batches of distinct ids to a keyed JDBC table, as ``writer`` among others."""

    def append(batch: DataFrame, check: bool) -> None:
        append_new_jdbc(batch, target, check, writer=writer)

    return _checking(append, sole_writer)


def committed_sink(path: str, writer: str) -> BatchSink:
    """Make each micro-batch count once by its number, as ``commit_batch`` does.

    ``writer`` names the checkpoint. The ids of a stream's batches must be distinct.
    """
    return lambda batch, batch_id: commit_batch(batch, path, writer, batch_id)


def bucketed_sink(table: BucketedTable, writer: str) -> BatchSink:
    """Append micro-batches to a table bucketed by id, which several writers may share."""
    return lambda batch, batch_id: table.append_new(batch, writer, batch_id)


def earliest_sink(
    path: str,
    key: str = KEY,
    order_by: tuple[str, ...] = (EVENT_TIME,),
    parts: tuple[str, ...] = PARTITION_COLUMNS,
) -> BatchSink:
    """Hold the earliest row of each id, over all micro-batches."""
    return lambda batch, _: merge_first(batch, path, key, order_by, parts)


def converting(sink: BatchSink, book: RateBook, fx: str = "divide") -> BatchSink:
    """Convert each micro-batch by the rates that are current when it runs.

    The stream gives dated rows with amount and currency; ``sink`` gets target rows.
    """
    if fx not in FX_MODES:
        raise ValueError(f"fx must be one of {FX_MODES}, not {fx!r}")
    return lambda batch, batch_id: sink(conform(usd_amount(batch, book.rates(), fx)), batch_id)


def start_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Append to files; the sink's own log makes each micro-batch count once."""
    return _writer(df, checkpoint, every, drain).format(fmt).option("path", path).start()


def start_kafka(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = None,
    drain: bool = False, options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Forward ``key, value`` messages to a topic."""
    chosen = kafka_write_options(servers, topic, options)
    return _writer(messages, checkpoint, every, drain).format("kafka").options(**chosen).start()


def start_console(
    df: DataFrame, checkpoint: str, every: str | None = None, drain: bool = False
) -> StreamingQuery:
    """Print micro-batches, for a look at a stream."""
    writer = _writer(df, checkpoint, every, drain).format("console")
    return writer.option("truncate", False).start()


def finish(query: StreamingQuery) -> None:
    """Process what is available, then stop between micro-batches."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def _requested(error: StreamingQueryException | None) -> bool:
    return error is not None and _STOPPED in str(error)


def stop_idle(query: StreamingQuery, patience: float = 60.0) -> None:
    """Stop a query when no micro-batch runs; after ``patience`` seconds, in any case."""
    end = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.02)
    query.stop()


def run_until_stopped(*queries: StreamingQuery, marker: str | None = None) -> None:
    """Wait for all queries; a failure or an interrupt stops the others too.

    So does the file ``marker``, between their micro-batches: where the queries were
    started with it, none is cut short.
    """
    spark = SparkSession.getActiveSession()
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(1)
            if marker is not None and path_exists(spark, marker):
                for query in queries:
                    stop_idle(query)
        for query in queries:
            query.awaitTermination()
    except KeyboardInterrupt:
        pass
    except StreamingQueryException as error:
        if not _requested(error):
            raise
        for query in queries:
            stop_idle(query)
    finally:
        for query in queries:
            query.stop()
    failures = [query.exception() for query in queries]
    if marker is not None:
        for failure in failures:
            if failure is not None and not _requested(failure):
                raise failure


def run_chain(
    first: DataFrame,
    links: Mapping[str, Callable[[DataFrame], DataFrame]],
    base: str,
    every: str | None = None,
    drain: bool = False,
    max_files_per_trigger: int | None = None,
) -> list[StreamingQuery]:
    """Streams one after another, each reading what the one before has committed.

    A link writes Parquet to ``base``/name with a checkpoint of its own. The file sink's log
    lists the files of whole micro-batches, and the next link reads that log, so any link
    may be killed and started again without losing or repeating a row. Draining, a link
    starts when the one before is done; otherwise all run at once.
    """
    queries, rows, spark = [], first, first.sparkSession
    for name, link in links.items():
        out = link(rows)
        path = f"{base}/{name}"
        make_folder(spark, path)
        queries.append(start_files(out, path, f"{base}/_check/{name}", every=every, drain=drain))
        if drain:
            queries[-1].awaitTermination()
        rows = parquet_rows(
            spark, path, out.schema, streaming=True, max_files_per_trigger=max_files_per_trigger
        )
    return queries
