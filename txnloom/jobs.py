"""Command line: ``python -m txnloom.jobs <job> ...``.

On a cluster: ``spark-submit --py-files txnloom.zip txnloom/jobs.py <job> ...``.

Jobs read messages from a Kafka topic (``--servers``, ``--topic``) or from a
folder (``--input``), as a stream that runs until stopped, or with ``--drain``
until the input is used up. ``--batch`` enriches a folder as one batch instead,
for loads larger than a stream should take at once. Publishing is one batch, or
with ``--checkpoint`` a stream over the folder, paced by ``--max-files`` and
``--every``.
"""

from __future__ import annotations

import argparse
import signal
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from txnloom import plans, sinks, sources, streaming
from txnloom.operators import rejected_csv, rejected_json
from txnloom.session import build_session, size_shuffle
from txnloom.sources import JdbcTarget

# The topics messages are published to and read from.
RAW_TOPIC = "raw-transactions"
NORMALIZED_TOPIC = "process-transactions"


def _message_arguments(job: argparse.ArgumentParser, topic: str) -> None:
    job.add_argument("--servers", help="Kafka bootstrap servers")
    job.add_argument("--topic", default=topic, help="topic to read")
    job.add_argument("--starting", default="latest", choices=("latest", "earliest"))
    job.add_argument("--min-partitions", type=int, help="split the topic into more tasks")
    job.add_argument("--max-offsets", type=int, help="records per micro-batch")
    _kafka_arguments(job)
    job.add_argument("--input", help="folder to read instead of a topic")
    job.add_argument("--input-format", default="parquet", choices=("parquet", "text"))
    _pace_arguments(job)


def _kafka_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument(
        "--kafka-option",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="further option of the Kafka connector, such as kafka.security.protocol=SSL",
    )


def _kafka_options(args: argparse.Namespace) -> dict[str, str]:
    pairs = [option.partition("=") for option in args.kafka_option]
    if not all(name and equals for name, equals, _ in pairs):
        raise SystemExit("--kafka-option takes NAME=VALUE")
    return {name: value for name, _, value in pairs}


def _pace_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument("--max-files", type=int, help="files per micro-batch")
    job.add_argument("--max-bytes", type=int, help="bytes of files per micro-batch, instead")


def _stream_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument("--checkpoint", help="shared folder for a stream's progress and state")
    job.add_argument("--every", help="micro-batch interval, such as '15 seconds'")
    job.add_argument("--drain", action="store_true", help="stop at the end of the input")


def _publish_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument("--csv", required=True, help="CSV files with a header line")
    job.add_argument("--servers", help="Kafka bootstrap servers")
    _kafka_arguments(job)
    job.add_argument("--to-topic", default=RAW_TOPIC)
    job.add_argument("--output", help="Parquet folder to write instead of a topic")
    job.add_argument("--limit", type=int, help="publish only the first so many rows, in one batch")
    _pace_arguments(job)
    _stream_arguments(job)


def _enrich_arguments(job: argparse.ArgumentParser, topic: str, fx: str) -> None:
    _message_arguments(job, topic)
    _stream_arguments(job)
    job.add_argument("--rates", required=True, help="CSV of currency,rate with a header")
    job.add_argument("--fx", default=fx, choices=("divide", "multiply"))
    job.add_argument("--spread", type=int, help="slots that split a hot transaction id")
    job.add_argument("--forget-after", help="forget a stream's ids so long after they arrived")
    job.add_argument("--rejects", help="Parquet folder for payloads without an id")
    job.add_argument("--output", help="Parquet table; the default is JDBC from DB_* variables")
    job.add_argument("--ranges", type=int, help="id ranges, hence files, per Parquet append")
    job.add_argument(
        "--sole-writer",
        action="store_true",
        help="the table holds only what this checkpoint wrote, so check one batch per run",
    )
    job.add_argument(
        "--writer",
        help="name of this checkpoint: each micro-batch counts once by its number, in a table "
        "of committed folders",
    )
    job.add_argument(
        "--buckets", type=int, help="with --writer, a table bucketed by id that jobs may share"
    )
    job.add_argument("--stop-marker", help="file that ends the stream between micro-batches")
    job.add_argument("--batch", action="store_true", help="read --input as one batch")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="txnloom", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("publish-json", help="CSV rows to JSON messages")
    _publish_arguments(job)
    job.add_argument("--key-column", help="field to key messages by")
    job.add_argument("--multiline", action="store_true", help="line breaks inside quotes")

    _publish_arguments(jobs.add_parser("publish-lines", help="CSV lines to messages as they are"))

    job = jobs.add_parser("normalize", help="timestamps in JSON messages to UTC")
    _message_arguments(job, RAW_TOPIC)
    _stream_arguments(job)
    job.add_argument("--to-topic", default=NORMALIZED_TOPIC)
    job.add_argument("--output", help="Parquet folder to write instead of a topic")
    job.add_argument("--key-column", help="field to key messages by")

    job = jobs.add_parser("enrich-json", help="JSON messages to the target table")
    _enrich_arguments(job, NORMALIZED_TOPIC, "multiply")
    job.add_argument("--strict", action="store_true", help="null where a token's type differs")

    job = jobs.add_parser("enrich-csv", help="CSV lines to the target table")
    _enrich_arguments(job, RAW_TOPIC, "divide")
    job.add_argument("--string-rule", action="store_true", help="date as written, time in zone")
    job.add_argument("--unquote", action="store_true", help="remove quotes from fields")

    jobs.add_parser("create-table", help="create the target table in the database")
    jobs.add_parser("check-jdbc", help="connect to the database and show its version")
    return top


def messages(spark: SparkSession, args: argparse.Namespace, streaming: bool = True) -> DataFrame:
    """The job's input with the payload in ``value``."""
    if args.input is None:
        if args.servers is None or not streaming:
            raise SystemExit("name --input, or --servers for a stream")
        return sources.kafka_stream(
            spark,
            args.servers,
            args.topic,
            starting=args.starting,
            min_partitions=args.min_partitions,
            max_offsets_per_trigger=args.max_offsets,
            options=_kafka_options(args),
        )
    read = sources.text_lines if args.input_format == "text" else sources.parquet_rows
    return read(
        spark,
        args.input,
        streaming=streaming,
        max_files_per_trigger=args.max_files,
        max_bytes_per_trigger=args.max_bytes,
    )


def checkpoint(args: argparse.Namespace, name: str) -> str:
    if args.checkpoint is None:
        raise SystemExit("a stream needs --checkpoint")
    return f"{args.checkpoint}/{name}"


def _forward(
    out: DataFrame, args: argparse.Namespace, progress: str | None
) -> list[StreamingQuery]:
    """Send messages to the job's folder or topic, as a stream if they are one."""
    if not out.isStreaming:
        if args.output is not None:
            out.write.mode("append").parquet(args.output)
        else:
            sinks.publish(out, args.servers, args.to_topic, _kafka_options(args))
        return []
    if args.output is not None:
        start = partial(streaming.start_files, out, args.output)
    else:
        start = partial(
            streaming.start_kafka, out, args.servers, args.to_topic, options=_kafka_options(args)
        )
    return [start(checkpoint=progress, every=args.every, drain=args.drain)]


def _first(args: argparse.Namespace) -> int | None:
    if args.limit is not None and args.checkpoint is not None:
        raise SystemExit("--limit needs one batch: leave out --checkpoint")
    return args.limit


def publish_json(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    rows = sources.csv_rows(
        spark,
        args.csv,
        streaming=args.checkpoint is not None,
        multiline=args.multiline,
        max_files_per_trigger=args.max_files,
        max_bytes_per_trigger=args.max_bytes,
        first=_first(args),
    )
    return _forward(plans.publish_json(rows, args.key_column), args, args.checkpoint)


def publish_lines(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    lines = sources.text_lines(
        spark,
        args.csv,
        streaming=args.checkpoint is not None,
        max_files_per_trigger=args.max_files,
        max_bytes_per_trigger=args.max_bytes,
        first=_first(args),
    )
    return _forward(plans.line_envelope(lines), args, args.checkpoint)


def normalize(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    out = plans.normalize_messages(messages(spark, args), args.key_column)
    return _forward(out, args, checkpoint(args, "normalize"))


def _load(
    spark: SparkSession,
    args: argparse.Namespace,
    enrich: Callable[..., DataFrame],
    rejected: Callable[[DataFrame], DataFrame],
) -> list[StreamingQuery]:
    """Enrich the input into the target table, as one batch or as a stream.

    With ``--rejects``, payloads without an id go to a folder of their own.
    """
    if args.spread and args.forget_after:
        raise SystemExit("choose --spread or --forget-after")
    if args.forget_after and (args.sole_writer or args.writer and not args.buckets):
        # a forgotten id can come again, and neither of these looks for it in the table
        raise SystemExit("--forget-after repeats ids: leave out --sole-writer, or add --buckets")
    if args.writer and args.output is None or args.buckets and not args.writer:
        raise SystemExit("--writer needs --output, and --buckets needs --writer")
    if args.batch and args.input is not None:
        size_shuffle(spark, args.input)
    payloads = messages(spark, args, streaming=not args.batch)
    rows = enrich(
        payloads,
        sources.rates_from_csv(spark, args.rates),
        fx=args.fx,
        with_id_only=args.rejects is not None,
        spread=args.spread,
        forget_after=args.forget_after,
    )
    rejects = args.rejects
    if args.batch:
        if args.output is not None:
            sinks.append_new(rows, args.output, unique=True, bulk=True, ranges=args.ranges)
        else:
            writer = args.job.replace("-", "_")
            sinks.append_new_jdbc(rows, JdbcTarget.from_env(), writer=writer)
        if rejects is not None:
            rejected(payloads).write.mode("append").parquet(rejects)
        return []
    progress = checkpoint(args, "table")
    start = partial(streaming.start_batches, marker=args.stop_marker)
    queries = [start(rows, _sink(args), progress, args.every, args.drain)]
    if rejects is not None:
        queries.append(
            streaming.start_files(
                rejected(payloads),
                rejects,
                checkpoint(args, "rejects"),
                every=args.every,
                drain=args.drain,
            )
        )
    return queries


def _sink(args: argparse.Namespace) -> streaming.BatchSink:
    if args.output is None:
        writer = args.job.replace("-", "_")
        return streaming.jdbc_sink(JdbcTarget.from_env(), args.sole_writer, writer)
    if args.buckets is not None:
        name = "table_" + "".join(c if c.isalnum() else "_" for c in args.output)
        table = sinks.BucketedTable(name, args.output, args.buckets)
        return streaming.bucketed_sink(table, args.writer)
    if args.writer is not None:
        return streaming.committed_sink(args.output, args.writer)
    return streaming.parquet_sink(args.output, args.sole_writer, args.ranges)


def enrich_json(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    return _load(spark, args, partial(plans.enrich_json, strict=args.strict), rejected_json)


def enrich_csv(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    enrich = partial(plans.enrich_csv, unquote=args.unquote, string_rule=args.string_rule)
    return _load(spark, args, enrich, partial(rejected_csv, unquote=args.unquote))


def create_table(spark: SparkSession, args: argparse.Namespace) -> None:
    sinks.create_table_jdbc(spark, JdbcTarget.from_env())


def check_jdbc(spark: SparkSession, args: argparse.Namespace) -> None:
    sources.check_connection(spark, JdbcTarget.from_env())


JOBS = {
    "publish-json": publish_json,
    "publish-lines": publish_lines,
    "normalize": normalize,
    "enrich-json": enrich_json,
    "enrich-csv": enrich_csv,
    "create-table": create_table,
    "check-jdbc": check_jdbc,
}


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    queries = JOBS[args.job](spark, args) or ()
    streaming.run_until_stopped(*queries, marker=getattr(args, "stop_marker", None))


def main() -> None:
    parser().parse_args()  # reject bad arguments before a session starts
    signal.signal(signal.SIGTERM, signal.default_int_handler)
    run(build_session())


if __name__ == "__main__":
    main()
