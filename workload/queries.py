"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnloom import operators as op
from txnloom import plans, sinks, sources, streaming
from txnloom.schema import FIELD_NAMES, HEADER_LINE, TARGET_NAMES, VELOCITY
from txnloom.session import list_names, scratch_path

from .tables import (
    FILE_ROWS,
    FIRST_LINES,
    LATER_RATES,
    LOOKED_UP,
    MIXED_TIMES,
    ODD_LINE,
    PACE,
    PACE_FILES,
    PACE_STREAMS,
    RATES,
    csv_line,
    csv_lines,
    pieces,
    rates,
    read_rows,
)

TYPED_NAMES = tuple(name for name in FIELD_NAMES if name != VELOCITY)


def use_utc(spark: SparkSession) -> None:
    """Calendar parts and offsets are read in the session zone; the SQL uses UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def json_payloads(rows: DataFrame) -> DataFrame:
    """Published messages: numbers and flags typed, the value as bytes."""
    messages = plans.publish_json(rows)
    return messages.withColumn("value", F.col("value").cast("binary"))


def line_payloads(rows: DataFrame) -> DataFrame:
    return csv_lines(rows).select(F.col("value").cast("binary").alias("value"))


def plain(df: DataFrame) -> DataFrame:
    """Widen floats and show timestamps as text, for comparison across engines."""
    shown = {}
    for name, kind in df.dtypes:
        if kind == "float":
            shown[name] = F.col(name).cast("double")
        elif kind == "timestamp":
            shown[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumns(shown) if shown else df


def with_known(df: DataFrame, *names: str) -> DataFrame:
    """Integer or boolean columns without their nulls, which engines type apart, and where they were."""
    zero = {"boolean": F.lit(False), "int": F.lit(0)}
    kinds = dict(df.dtypes)
    known = {f"{name}_known": F.col(name).isNotNull() for name in names}
    return df.withColumns(known).withColumns(
        {name: F.coalesce(name, zero[kinds[name]]) for name in names}
    )


def offset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids with their time written as if five hours west of Greenwich."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-05:00")).alias(
            "timestamp"
        ),
    )


def broken_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("merchant", F.concat("merchant", F.lit("\n"), "city"))


def odd_lines(rows: DataFrame) -> DataFrame:
    """Lines with an unpaired quote, runs of quotes, line breaks and the splitter's own marks."""
    return rows.select(F.expr(ODD_LINE[0]).alias("value"))


MESSAGE = "value binary"


def message_files(spark: SparkSession, sf_dir: str, deliveries: int) -> tuple[str, int]:
    """A folder of published events, each twice and the copies in different files; files of a delivery.

    The number of files of a delivery grows with the table. Copies are a delivery's files apart.
    """
    folder = scratch_path(spark, "messages")
    each = pieces(spark, sf_dir, "events", deliveries * FILE_ROWS // 2)
    files = deliveries * each
    sent = json_payloads(read_rows(spark, sf_dir, "events"))
    copies = sent.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(1))))
    place = F.pmod(F.xxhash64("value") + F.col("copy") * each, F.lit(files)).cast("int")
    placed = copies.repartitionById(files, place).sortWithinPartitions("copy")
    placed.select("value").write.parquet(folder)
    return folder, each


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, computed once into the scratch folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def twice(df: DataFrame) -> DataFrame:
    """Every row delivered a second time, as an at-least-once topic may."""
    return df.unionByName(df)


# ---------------------------------------------------------------- sources


def src_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    rows = read_rows(spark, sf_dir, "events")
    rows.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return sources.csv_rows(spark, path)


def src_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose merchant holds a line break, quotes and a comma."""
    path = scratch_path(spark, "csv-multiline")
    rows = broken_rows(read_rows(spark, sf_dir, "events"))
    rows.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return sources.csv_rows(spark, path, multiline=True)


def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    rows = read_rows(spark, sf_dir, "events")
    third = F.col("transaction_id").cast("long") % 3
    # files with two different first lines
    headed = (rows.where(third == 0), rows.where(third == 1).toDF(*(n.upper() for n in rows.columns)))
    for part in headed:
        writer = part.write.mode("append").option("header", True).option("escape", '"')
        writer.option("emptyValue", "").csv(path)
    # files whose first line is blank, with blank lines and data like a header between
    part = rows.where(third == 2)
    blank = F.concat(F.lit("\n"), csv_line(part), F.lit("\n" + HEADER_LINE))
    part.select(blank.alias("value")).write.mode("append").text(path)
    return sources.text_lines(spark, path)


def src_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thousand lines of files in order of path, each with a header."""
    path = scratch_path(spark, "ordered")
    rows = read_rows(spark, sf_dir, "events")
    place = F.col("transaction_id").cast("long")
    ranges = 4 * pieces(spark, sf_dir, "events", 4 * FILE_ROWS)
    ordered = rows.repartitionByRange(ranges, place).sortWithinPartitions(place)
    ordered.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return sources.text_lines(spark, path, first=FIRST_LINES)


def src_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = json_payloads(read_rows(spark, sf_dir, "events", streaming=True))
    fields = op.parse_wire_json(op.payload_to_string(incoming), keep=("key",))
    out = scratch_path(spark, "json-stream")
    query = streaming.start_files(fields, out, scratch_path(spark, "checkpoint"), drain=True)
    query.awaitTermination()
    return spark.read.schema(fields.schema).parquet(out)


def dim_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = read_rows(spark, sf_dir, "events").select("currency").distinct()
    return op.join_currency(used, rates(spark))


# ---------------------------------------------------------------- parsing


def payload_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.payload_to_string(line_payloads(read_rows(spark, sf_dir, "events")))


def parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = json_payloads(read_rows(spark, sf_dir, "events"))
    return plain(op.parse_json(op.payload_to_string(payloads))).select(*TYPED_NAMES)


def parse_json_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_rows(spark, sf_dir, "events")
    typed = op.coerce_strict(rows).withColumn(
        VELOCITY, F.from_json(VELOCITY, "map<string,string>")
    )
    payloads = plans.json_envelope(typed)
    parsed = op.parse_json(payloads, strict=True, velocity=True)
    shown = with_known(plain(parsed), "distance_from_home", "transaction_hour")
    return shown.withColumn("velocity_k", F.col(VELOCITY)["k"]).drop(VELOCITY)


def parse_csv_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = line_payloads(read_rows(spark, sf_dir, "events"))
    return op.parse_csv_line(op.payload_to_string(payloads))


def parse_csv_unquoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = csv_lines(read_rows(spark, sf_dir, "events"))
    return op.parse_csv_line(lines, unquote=True)


def json_type_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as published, every seventh cut short, every fifth with a flag as text."""
    rows = op.coerce_strict(read_rows(spark, sf_dir, "events"))
    place = F.col("transaction_id").cast("long")
    value = plans.json_value(rows)
    flag = F.concat(F.lit('"card_present":"'), F.col("card_present").cast("string"), F.lit('"'))
    text = F.regexp_replace(value, F.lit('"card_present":(true|false)'), flag)
    sent = F.when(place % 7 == 0, F.substring(value, 1, 40)).when(place % 5 == 0, text)
    return op.json_type_faults(rows.select(sent.otherwise(value).alias("value")))


def parse_csv_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_csv_line(odd_lines(read_rows(spark, sf_dir, "events")))


def cast_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_known(plain(op.cast_fields(read_rows(spark, sf_dir, "events"))), "card_present")


def coerce_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.coerce_strict(read_rows(spark, sf_dir, "events"))


# ---------------------------------------------------------------- time


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return op.add_calendar(events).drop("timestamp")


def calendar_parts_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.add_calendar(offset_rows(spark, sf_dir), string_rule=True).drop("timestamp")


def calendar_parts_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.add_calendar(offset_rows(spark, sf_dir)).drop("timestamp")


def normalize_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.normalize_timestamp(offset_rows(spark, sf_dir))


def normalize_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.normalize_messages(json_payloads(read_rows(spark, sf_dir, "events")))


def normalize_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with unknown keys and a nested object that has a time of its own."""
    rows = op.coerce_strict(read_rows(spark, sf_dir, "events"))
    lead = F.concat(F.lit('{"extra":1.50,"in":{"timestamp":"'), "timestamp", F.lit('","n":12.0},'))
    text = F.expr("substring(value, 2)")
    sent = rows.select("timestamp", plans.json_value(rows).alias("value"))
    return plans.normalize_messages(sent.select(F.concat(lead, text).alias("value")))


# ---------------------------------------------------------------- currency


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_rows(spark, sf_dir, "lineitem")
    return op.cast_fields(rows).select("transaction_id", "city", "amount", "currency")


def join_currency_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(op.join_currency(_amounts(spark, sf_dir), rates(spark)))


def fx_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(op.usd_amount(_amounts(spark, sf_dir), rates(spark), "divide"))


def fx_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(op.usd_amount(_amounts(spark, sf_dir), rates(spark), "multiply"))


# ---------------------------------------------------------------- de-duplication


def dedup_transaction_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(op.drop_repeated_ids(op.cast_fields(read_rows(spark, sf_dir, "lineitem"))))


def dedup_mixed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest instant survives, whatever offset it is written in; rows without a time come last."""
    rows = read_rows(spark, sf_dir, "lineitem").withColumn("timestamp", F.expr(MIXED_TIMES[0]))
    return plain(op.drop_repeated_ids(op.cast_fields(rows)))


# ---------------------------------------------------------------- messages


def to_json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.publish_json(read_rows(spark, sf_dir, "events"))


def to_line_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_rows(spark, sf_dir, "lineitem")
    padded = F.concat(F.lit(" \t"), csv_line(rows), F.lit("\r\n"))
    return plans.line_envelope(rows.select(padded.alias("value")))


# ---------------------------------------------------------------- pipelines


def enrich_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = line_payloads(read_rows(spark, sf_dir, "lineitem"))
    return plans.enrich_csv(payloads, rates(spark))


def enrich_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = json_payloads(read_rows(spark, sf_dir, "lineitem"))
    return plans.enrich_json(payloads, rates(spark))


def _event_target(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Target rows from the events table, each event delivered twice."""
    payloads = json_payloads(twice(read_rows(spark, sf_dir, "events", streaming=stream)))
    return plans.enrich_json(payloads, rates(spark))


# ---------------------------------------------------------------- sinks


def target_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "target")
    name = "target_" + path.rpartition("-")[2]
    sinks.create_table(spark, name, path)
    sinks.create_table(spark, name, path)
    sinks.write_partitioned(_event_target(spark, sf_dir), path)
    spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*TARGET_NAMES)


def sink_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "batches")
    query = streaming.start_batches(
        _event_target(spark, sf_dir, stream=True),
        streaming.parquet_sink(path),
        scratch_path(spark, "checkpoint"),
        drain=True,
    )
    query.awaitTermination()
    return sinks.read_table(spark, path)


def sink_idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events go in, then again together with as many new ids; each id is stored once."""
    path = scratch_path(spark, "append")
    events = stored(_event_target(spark, sf_dir), "events")
    others = events.withColumn("transaction_id", F.concat(F.lit("E"), "transaction_id"))
    sinks.append_new(events, path)
    sinks.append_new(events.unionByName(others), path)
    return sinks.read_table(spark, path)


def partitioned_sink_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lookup")
    sinks.write_partitioned(_event_target(spark, sf_dir), path)
    return sinks.lookup(spark, path, year=2024, month=1, day=1, transaction_id="150")


# ---------------------------------------------------------------- streams


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines through the CSV pipeline as a stream, de-duplication included."""
    lines = line_payloads(twice(read_rows(spark, sf_dir, "events", streaming=True)))
    enriched = plans.enrich_csv(lines, rates(spark))
    out = scratch_path(spark, "stream-enrich")
    query = streaming.start_files(enriched, out, scratch_path(spark, "checkpoint"), drain=True)
    query.awaitTermination()
    return with_known(spark.read.schema(enriched.schema).parquet(out), "card_present")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = twice(read_rows(spark, sf_dir, "events", streaming=True))
    unique = op.drop_repeated_ids(rows.select("transaction_id", "timestamp", "merchant"))
    out = scratch_path(spark, "stream-dedup")
    query = streaming.start_files(unique, out, scratch_path(spark, "checkpoint"), drain=True)
    query.awaitTermination()
    return spark.read.schema(unique.schema).parquet(out)


def stream_dedup_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = twice(read_rows(spark, sf_dir, "events", streaming=True))
    unique = op.drop_repeated_ids_spread(rows.select("transaction_id", "timestamp", "merchant"))
    out = scratch_path(spark, "stream-spread")
    query = streaming.start_files(unique, out, scratch_path(spark, "checkpoint"), drain=True)
    query.awaitTermination()
    return spark.read.schema(unique.schema).parquet(out)


def stream_dedup_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows in two micro-batches with the same ids; ids are kept for an hour."""
    columns = ("transaction_id", "timestamp", "merchant")
    rows = read_rows(spark, sf_dir, "events").select(*columns)
    rows = rows.repartition(spark.sparkContext.defaultParallelism)
    folder = scratch_path(spark, "twice")
    for _ in range(2):
        rows.write.mode("append").parquet(folder)
    # half of the files are one delivery
    files = len(spark.read.schema(rows.schema).parquet(folder).inputFiles()) // 2
    stream = sources.parquet_rows(
        spark, folder, rows.schema, streaming=True, max_files_per_trigger=files
    )
    unique = op.drop_repeated_ids_within(stream, "1 hour")
    out = scratch_path(spark, "stream-within")
    query = streaming.start_files(unique, out, scratch_path(spark, "checkpoint"), drain=True)
    query.awaitTermination()
    return spark.read.schema(unique.schema).parquet(out)


# ---------------------------------------------------------------- sinks that count once


def sink_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch is written, fails before it is committed, and is delivered again to a new sink."""
    folder, files = message_files(spark, sf_dir, 4)
    path, checkpoint = scratch_path(spark, "committed"), scratch_path(spark, "checkpoint")

    def run(fail_after: int | None) -> None:
        sink = streaming.committed_sink(path, "json")

        def losing(batch: DataFrame, batch_id: int) -> None:
            sink(batch, batch_id)
            if batch_id == fail_after:
                raise RuntimeError("lost after the write")

        stream = sources.parquet_rows(
            spark, folder, MESSAGE, streaming=True, max_files_per_trigger=files
        )
        rows = plans.enrich_json(stream, rates(spark))
        query = streaming.start_batches(rows, losing, checkpoint, drain=True)
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if "lost after the write" not in str(error):
                raise

    for fail_after in (1, 2, None):
        run(fail_after)
    sinks.compact(spark, path, "json")
    return sinks.read_committed(spark, path)


def bucketed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers share the table: one checks before the other has written, one delivers twice."""
    place = scratch_path(spark, "bucketed")
    buckets = 8 * pieces(spark, sf_dir, "events", 8 * FILE_ROWS)
    table = sinks.BucketedTable("bucketed_" + place.rpartition("-")[2], place, buckets)
    events = stored(_event_target(spark, sf_dir), "events")
    others = events.withColumn("transaction_id", F.concat(F.lit("E"), "transaction_id"))
    nothing = table.open(spark).limit(0)
    # both writers find the table empty and store the events
    table.append_new(events, "json", 0)
    table.append_new(events, "csv", 0, stored=nothing)
    for _ in range(2):
        table.append_new(events.unionByName(others), "csv", 1)
    return table.unique_rows(spark)


def lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some ids, looked up in the table without a date."""
    path = scratch_path(spark, "by-id")
    sinks.write_partitioned(_event_target(spark, sf_dir), path)
    return sinks.lookup(spark, path, transaction_id=LOOKED_UP)


# ---------------------------------------------------------------- streams that stop and resume


def stream_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of ids out of order over micro-batches; the table holds the earliest of each."""
    folder = scratch_path(spark, "unordered")
    rows = op.cast_fields(read_rows(spark, sf_dir, "lineitem"))
    dated = rows.withColumn("year", F.year(F.col("timestamp").cast("timestamp")))
    parts = 3 * pieces(spark, sf_dir, "lineitem", 3 * FILE_ROWS)
    dated.repartition(parts, F.xxhash64("transaction_id", "city")).write.parquet(folder)
    files = len(spark.read.parquet(folder).inputFiles())
    stream = sources.parquet_rows(
        spark, folder, dated.schema, streaming=True, max_files_per_trigger=max(1, files // 3)
    )
    path = scratch_path(spark, "earliest")
    query = streaming.start_batches(
        stream,
        streaming.earliest_sink(path, parts=("year",)),
        scratch_path(spark, "checkpoint"),
        drain=True,
    )
    query.awaitTermination()
    return plain(spark.read.schema(dated.schema).parquet(path).select(*FIELD_NAMES))


def paced_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each micro-batch of streams that may take one file of a thousand ids at a time.

    The micro-batches of a stream wait for each other, so many files are dealt to several streams.
    """
    folder = scratch_path(spark, "paced")
    part = F.floor(F.col("event_id") / PACE).alias("part")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", part)
    streams = min(PACE_STREAMS, pieces(spark, sf_dir, "events", PACE * PACE_FILES))
    lane = F.coalesce(F.pmod("part", F.lit(streams)), F.lit(0))
    placed = events.withColumn("lane", lane).repartition("part")
    placed.write.partitionBy("lane", "part").parquet(folder)
    backlog = streaming.Backlog(most=None)  # one report for each file
    spark.streams.addListener(backlog)
    queries = []
    try:
        with streaming.plain_logs(spark, folder):
            for name in list_names(spark, folder):
                if not name.startswith("lane="):
                    continue
                stream = sources.parquet_rows(
                    spark,
                    f"{folder}/{name}",
                    "event_id long, part long",
                    streaming=True,
                    max_bytes_per_trigger=1,
                )
                out, checkpoint = scratch_path(spark, "paced-out"), scratch_path(spark, "checkpoint")
                query = streaming.start_files(stream, out, checkpoint, drain=True)
                queries.append((query, name, checkpoint))
            streaming.run_until_stopped(*(query for query, _, _ in queries))
        for _, name, checkpoint in queries:
            if streaming.files_behind(spark, f"{folder}/{name}", checkpoint):
                raise AssertionError("files are left")
        reports = [(r.rows,) for query, _, _ in queries for r in backlog.of(query) if r.rows]
    finally:
        spark.streams.removeListener(backlog)
    return spark.createDataFrame(reports, "n_rows long")


def graceful_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stop is asked for during the first micro-batch; a second run takes up the rest."""
    folder, files = message_files(spark, sf_dir, 3)
    path, checkpoint = scratch_path(spark, "stopped"), scratch_path(spark, "checkpoint")
    marker = scratch_path(spark, "stop-marker")
    sink = streaming.committed_sink(path, "json")

    def asked(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        if batch_id == 0:
            streaming.request_stop(spark, marker)

    for run in range(2):
        stream = sources.parquet_rows(
            spark, folder, MESSAGE, streaming=True, max_files_per_trigger=files
        )
        rows = plans.enrich_json(stream, rates(spark))
        query = streaming.start_batches(rows, asked, checkpoint, drain=True, marker=marker)
        streaming.run_until_stopped(query, marker=marker)
        if run == 0:
            if sinks.commits(spark, path).count() != 1:
                raise AssertionError("the stream did not stop after the batch it was asked in")
            streaming.withdraw_stop(spark, marker)
    return sinks.read_committed(spark, path)


def stream_rate_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events under the first rates; odd ones after the rates were published anew."""
    book = sources.RateBook(spark, scratch_path(spark, "rate-book"))
    payloads = json_payloads(read_rows(spark, sf_dir, "events"))
    even = F.get_json_object(F.col("value").cast("string"), "$.transaction_id").cast("long") % 2 == 0
    folder = scratch_path(spark, "messages")
    path, checkpoint = scratch_path(spark, "rated"), scratch_path(spark, "checkpoint")
    sink = streaming.converting(streaming.committed_sink(path, "json"), book, "multiply")
    versions = []
    for table, part in ((RATES, even), (LATER_RATES, ~even)):
        payloads.where(part).select("value").write.mode("append").parquet(folder)
        for _ in range(2):  # equal rates again are the same version
            versions.append(book.publish(sources.rates_from_mapping(spark, table)))
        stream = sources.parquet_rows(spark, folder, MESSAGE, streaming=True)
        fields = op.parse_json(op.payload_to_string(stream))
        dated = op.add_calendar(op.drop_repeated_ids(fields))
        streaming.start_batches(dated, sink, checkpoint, drain=True).awaitTermination()
    if len(set(versions)) != 2:
        raise AssertionError("equal rates must be one version")
    return sinks.read_committed(spark, path)


def stream_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishing, normalising and enriching as three streams; the middle one is killed once."""
    base = scratch_path(spark, "chain")
    rows = scratch_path(spark, "rows")
    typed = read_rows(spark, sf_dir, "events")
    files = pieces(spark, sf_dir, "events", 3 * FILE_ROWS)
    typed.repartition(3 * files).write.parquet(rows)
    stream = sources.parquet_rows(
        spark, rows, typed.schema, streaming=True, max_files_per_trigger=files
    )
    publish = {"raw": plans.publish_json}
    streaming.run_chain(stream, publish, base, drain=True)
    links = {"normalized": plans.normalize_messages}

    def raw() -> DataFrame:
        return sources.parquet_rows(
            spark,
            f"{base}/raw",
            "key string, value string",
            streaming=True,
            max_files_per_trigger=files,
        )

    (middle,) = streaming.run_chain(raw(), links, base)
    while middle.isActive and middle.lastProgress is None:
        middle.awaitTermination(1)
    middle.stop()
    streaming.run_chain(raw(), links, base, drain=True)
    sent = sources.parquet_rows(
        spark, f"{base}/normalized", "key string, value string", streaming=True
    )
    path = f"{base}/table"
    enriched = plans.enrich_json(sent, rates(spark))
    sink = streaming.committed_sink(path, "json")
    streaming.start_batches(enriched, sink, f"{base}/_check/table", drain=True).awaitTermination()
    return sinks.read_committed(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        src_csv_header,
        src_csv_multiline,
        src_text_lines,
        src_first_lines,
        src_json_stream,
        dim_currency,
        payload_to_string,
        parse_json,
        parse_json_strict,
        parse_csv_line,
        parse_csv_unquoted,
        parse_csv_odd,
        json_type_faults,
        cast_fields,
        coerce_strict,
        calendar_parts,
        calendar_parts_string,
        calendar_parts_instant,
        normalize_timestamp,
        normalize_messages,
        normalize_nested,
        join_currency_left,
        fx_divide,
        fx_multiply,
        dedup_transaction_id,
        dedup_mixed_times,
        to_json_envelope,
        to_line_envelope,
        target_contract,
        sink_foreach_batch,
        sink_idempotent_append,
        partitioned_sink_lookup,
        stream_enrich,
        stream_dedup,
        stream_dedup_spread,
        stream_dedup_within,
        sink_redelivery,
        bucketed_append,
        lookup_by_id,
        stream_earliest,
        paced_ingest,
        graceful_stop,
        stream_rate_update,
        stream_chain,
        enrich_csv,
        enrich_json,
    )
}

