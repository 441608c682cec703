"""Stopping on request, backlogs, versioned rates, chains, and the options of jobs that use them."""

from __future__ import annotations

import json
import threading
import time
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryProgress

from tests.conftest import plan_of, values
from tests.test_streaming import message_folder, stream_of
from tests.test_jobs import files  # noqa: F401
from txnloom import jobs, plans, session, sinks, sources, streaming
from txnloom import operators as op
from txnloom.session import list_names, path_exists, scratch_path
from txnloom.sources import RateBook, rates_from_mapping
from workload import queries


# ---------------------------------------------------------------- stopping


def test_a_stop_ends_busy_and_idle_queries_between_batches(spark, payload):
    folder, add = message_folder(spark, [payload(transaction_id="0")])
    marker = scratch_path(spark, "marker")
    seen = []

    def slow(batch, batch_id):
        seen.append(batch.count())
        add(payload(transaction_id=str(batch_id)))
        if batch_id == 2:
            streaming.request_stop(spark, marker)

    busy = streaming.start_batches(
        stream_of(spark, folder), slow, scratch_path(spark, "check"), marker=marker
    )
    still, _ = message_folder(spark, [payload()])
    idle = streaming.start_batches(
        stream_of(spark, still), lambda batch, _: batch.count(), scratch_path(spark, "check"), marker=marker
    )
    streaming.run_until_stopped(busy, idle, marker=marker)
    assert not busy.isActive and not idle.isActive and seen == [1, 1, 1]
    streaming.withdraw_stop(spark, marker)
    assert not path_exists(spark, marker)


def test_a_failure_beside_a_stop_is_raised(spark, payload):
    folder, _ = message_folder(spark, [payload()])
    marker = scratch_path(spark, "marker")

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    query = streaming.start_batches(
        stream_of(spark, folder), fail, scratch_path(spark, "check"), marker=marker
    )
    with pytest.raises(Exception, match="sink is down"):
        streaming.run_until_stopped(query, marker=marker)


# ---------------------------------------------------------------- backlog


def test_the_backlog_falls_as_files_are_taken(spark, payload):
    folder, add = message_folder(spark, [payload()])
    for i in range(3):
        add(payload(transaction_id=str(i)), payload())
    backlog, checkpoint, left = streaming.Backlog(most=3), scratch_path(spark, "check"), []

    def sink(batch, batch_id):
        batch.count()
        left.append(streaming.files_behind(spark, folder, checkpoint))

    spark.streams.addListener(backlog)
    try:
        stream = stream_of(spark, folder, max_bytes_per_trigger=1)
        query = streaming.start_batches(stream, sink, checkpoint, drain=True)
        query.awaitTermination()
        reports = [r for r in backlog.of(query) if r.rows]
    finally:
        spark.streams.removeListener(backlog)
    assert [r.rows for r in reports] == [2, 2, 2][: len(reports)] and len(reports) >= 2
    assert left == [3, 2, 1, 0]
    with pytest.raises(ValueError, match="files or by bytes"):
        stream_of(spark, folder, max_bytes_per_trigger=1, max_files_per_trigger=1)


def test_a_report_comes_in_one_call_not_field_by_field(spark, payload, monkeypatch):
    folder, add = message_folder(spark, [payload()])
    for i in range(3):
        add(payload(transaction_id=str(i)), payload())
    slow, convert = [], StreamingQueryProgress.fromJObject

    def counted(progress):
        slow.append(progress)
        return convert(progress)

    monkeypatch.setattr(StreamingQueryProgress, "fromJObject", counted)
    backlog = streaming.Backlog()
    spark.streams.addListener(backlog)
    try:
        stream = stream_of(spark, folder, max_bytes_per_trigger=1)
        out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "check")
        query = streaming.start_files(stream, out, checkpoint, drain=True)
        query.awaitTermination()
        reports = [(r.batch_id, r.rows) for r in backlog.of(query) if r.rows]
    finally:
        spark.streams.removeListener(backlog)
    assert reports == [(0, 1), (1, 2), (2, 2), (3, 2)]
    assert len(slow) <= 1


def _report(query, batch_id, rows=1):
    return json.dumps(
        {
            "runId": str(query.runId),
            "batchId": batch_id,
            "numInputRows": rows,
            "batchDuration": 1500,
            "sources": [{"metrics": {"maxOffsetsBehindLatest": "2"}}, {}],
        }
    )


def _ended(last=None):
    return SimpleNamespace(runId=uuid.uuid4(), isActive=False, lastProgress=last)


def test_reports_that_still_come_in_are_waited_for():
    backlog, query = streaming.Backlog(), _ended()

    def late():
        for batch_id in range(5):
            backlog.keep(_report(query, batch_id))
            time.sleep(0.3)
        backlog.onQueryTerminated(SimpleNamespace(runId=query.runId))

    thread = threading.Thread(target=late)
    thread.start()
    reports = backlog.of(query, timeout=1.0)
    thread.join()
    assert [(r.batch_id, r.seconds, r.backlog) for r in reports] == [
        (batch_id, 1.5, {"maxOffsetsBehindLatest": 2.0}) for batch_id in range(5)
    ]
    with pytest.raises(TimeoutError):
        backlog.of(_ended(), timeout=0.1)


@pytest.mark.parametrize(
    "seen, last, whole",
    [
        ([3, 4, 5], (5, 1), True),
        ([3, 4, 5], (6, 0), True),  # the idle trigger after the last batch
        ([3, 5], (5, 1), False),
        ([3, 4], (5, 1), False),
        ([3, 4], (6, 0), False),
    ],
)
def test_lost_reports_are_an_error(seen, last, whole):
    backlog = streaming.Backlog(most=2)
    query = _ended(SimpleNamespace(batchId=last[0], numInputRows=last[1]))
    for batch_id in seen:
        backlog.keep(_report(query, batch_id))
    backlog.onQueryTerminated(SimpleNamespace(runId=query.runId))
    if whole:
        assert [r.batch_id for r in backlog.of(query)] == seen[-2:]
    else:
        with pytest.raises(RuntimeError, match="lost"):
            backlog.of(query)


def test_logs_on_a_local_disk_are_written_by_fewer_processes(spark, payload, conf, monkeypatch):
    folder, add = message_folder(spark, [payload()])
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "check")
    key = "spark.sql.streaming.checkpointFileManagerClass"
    spark_streaming = "org.apache.spark.sql.execution.streaming"

    def run():
        with streaming.plain_logs(spark, out):
            query = streaming.start_files(stream_of(spark, folder), out, checkpoint, drain=True)
            query.awaitTermination()
        used = query._jsq.streamingQuery().sparkSessionForStream().conf().get(key)
        return used.rpartition(".")[2], spark.read.schema("value string").parquet(out).count()

    assert not session.has_class(spark, "org.apache.spark.NoSuchThing")
    assert run() == ("FileSystemBasedCheckpointFileManager", 1)
    assert spark.conf.get(key, None) is None
    add(payload(transaction_id="2"))
    # a setting of the session stays, and either continues the logs of the other
    package = session.has_class(spark, f"{spark_streaming}.checkpointing.CheckpointFileManager")
    chosen = spark_streaming + ".checkpointing" * package + ".FileContextBasedCheckpointFileManager"
    conf(key, chosen)
    assert run() == ("FileContextBasedCheckpointFileManager", 2)
    assert spark.conf.get(key) == chosen
    spark.conf.unset(key)
    add(payload(transaction_id="3"))
    assert run() == ("FileSystemBasedCheckpointFileManager", 3)
    # elsewhere nothing changes
    monkeypatch.setattr(streaming.runner, "on_local_disk", lambda *_: False)
    with streaming.plain_logs(spark, out):
        assert spark.conf.get(key, None) is None


def test_paced_streams_write_plain_logs(spark, sf_dir, monkeypatch):
    seen, start = [], streaming.start_files

    def noted(*args, **more):
        seen.append(spark.conf.get("spark.sql.streaming.checkpointFileManagerClass", "usual"))
        return start(*args, **more)

    monkeypatch.setattr(streaming, "start_files", noted)
    queries.paced_ingest(spark, sf_dir)
    assert seen and all(name.endswith(".FileSystemBasedCheckpointFileManager") for name in seen)


def test_files_are_listed_alike_on_a_local_disk_and_elsewhere(spark, tmp_path):
    for name in ("b=1/y", "b=1/.y.crc", "a/deep/z", "a/_SUCCESS", "_hidden/x", "top"):
        place = tmp_path / "files" / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text("x")
    base = f"file:{tmp_path}/files"
    every = [f"{base}/{name}" for name in ("_hidden/x", "a/deep/z", "b=1/y", "top")]
    for path, want in ((base, every), (f"{base}/*=1", every[2:3]), (f"{base}/top", every[3:]), (f"{base}/no", [])):
        assert session.input_files(spark, path) == want
        file_system, jvm_path = session._located(spark, path)
        for start in file_system.globStatus(jvm_path) or ():
            lists = (session._listed, session._walked)
            listed, walked = ({f.toString() for f in way(file_system, start.getPath())} for way in lists)
            assert listed == walked


# ---------------------------------------------------------------- rates


def test_equal_rates_are_one_version(spark, tmp_path):
    book = RateBook(spark, str(tmp_path / "book"))
    with pytest.raises(ValueError, match="no rates"):
        book.rates()
    first = book.publish(rates_from_mapping(spark, {"EUR": 2.0, "USD": 1.0}))
    state = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "book").iterdir()}
    assert book.publish(rates_from_mapping(spark, {"USD": 1.0, "EUR": 2.0})) == first
    assert {f.name: f.stat().st_mtime_ns for f in (tmp_path / "book").iterdir()} == state
    second = book.publish(rates_from_mapping(spark, {"EUR": 1.0, "USD": 2.0}))
    assert second != first and values(book.rates()) == [("EUR", 1.0), ("USD", 2.0)]
    assert book.publish(rates_from_mapping(spark, {"EUR": 2.0, "USD": 1.0})) == first
    assert book.current() == first
    twice = rates_from_mapping(spark, {"EUR": 2.0}).union(rates_from_mapping(spark, {"EUR": 3.0}))
    with pytest.raises(ValueError, match="twice"):
        book.publish(twice)


def test_planning_writes_no_rates(spark, rates, payload):
    payloads = spark.createDataFrame([(payload(),)], "value string")
    place = scratch_path(spark, "x").rpartition("/")[0]
    before = list_names(spark, place)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    enriched = plans.enrich_json(payloads, rates)
    spark.sparkContext.setJobGroup("other", "")
    added = [n for n in list_names(spark, place) if n not in before and n.startswith("rates")]
    assert not added and not tracker.getJobIdsForGroup("planning")
    assert enriched.first()["rate_usd"] == 1.75
    many = rates_from_mapping(spark, {f"C{i}": 1.0 + i for i in range(30)})
    df = spark.createDataFrame([("C7",), ("X",), (None,)], "currency string")
    joined = op.join_currency(df, many, max_broadcast_rates=10)
    assert values(joined, "currency", "rate") == [("C7", 8.0), ("X", None), (None, None)]
    assert "_salt" in plan_of(op.join_currency(df, many, 10))


# ---------------------------------------------------------------- messages


@pytest.mark.parametrize(
    "sent, want",
    [
        ('{"a":{"timestamp":"T"},"timestamp":"T","d":12.0}', '{"a":{"timestamp":"T"},"timestamp":"N","d":12.0}'),
        ('{"timestamp" : "T", "x":"\\\\\\"timestamp\\":\\"T\\"", "l":[{"timestamp":"T"}]}', None),
        ('{"s":"{","timestamp":"T","timestamps":"T","k":"timestamp","e":1E400}', None),
        ('{"k":"\\\\","timestamp":"T","n":{"timestamp":["timestamp",{"timestamp":"T"}]}}', None),
        ('{"timestamp":"T","timestamp":"T"}', '{"timestamp":"N","timestamp":"N"}'),
    ],
)
def test_only_the_messages_own_time_is_changed(spark, sent, want):
    old, new = "2024-09-30T02:00:01+02:00", "2024-09-30T00:00:01.000Z"
    if want is None:
        head, _, tail = sent.partition('"timestamp"')
        if '{"timestamp"' in sent[:13] or head.endswith(","):
            want = sent.replace('"T"', '"N"', 1) if head + '"timestamp"' in sent else sent
    df = spark.createDataFrame([(sent.replace("T\"", old + '"').replace("T\\", old + "\\"),)], "value string")
    got = plans.normalize_messages(df).first()["value"]
    assert got == want.replace("N\"", new + '"').replace("T\"", old + '"').replace("T\\", old + "\\")


def test_many_names_take_time_in_proportion(spark):
    inner = ",".join('{"timestamp":"x"}' for _ in range(30_000))
    sent = '{"l":[%s],"timestamp":"2024-09-30T00:00:01Z"}' % inner
    got = plans.normalize_messages(spark.createDataFrame([(sent,)], "value string")).first()["value"]
    assert got == sent.replace("01Z", "01.000Z")


def test_type_faults_of_odd_payloads(spark, payload):
    rows = [payload(), payload(amount="many", card_present=1), payload(distance_from_home=1.5), "[1]", "5", "{", None, "{}"]
    rows += [payload(velocity_last_hour="x", transaction_hour=None), payload(transaction_id=5)]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    got = {(r["field"], r["found"]): r["n"] for r in op.json_type_faults(df).collect()}
    assert got == {
        ("amount", "STRING"): 1, ("card_present", "BIGINT"): 1, ("distance_from_home", "DECIMAL"): 1,
        ("velocity_last_hour", "STRING"): 1, ("-", "no object"): 4,
    }


# ---------------------------------------------------------------- chains and jobs


def test_a_chain_runs_all_links_at_once(spark, payload):
    folder, _ = message_folder(spark, [payload(transaction_id="1")])
    base = scratch_path(spark, "chain")
    links = {"normalized": plans.normalize_messages, "again": plans.normalize_messages}
    queries = streaming.run_chain(stream_of(spark, folder), links, base)
    try:
        for query in queries:
            while query.isActive and not any(p["numInputRows"] for p in query.recentProgress):
                query.awaitTermination(1)
    finally:
        for query in reversed(queries):
            streaming.stop_idle(query)
    assert json.loads(spark.read.parquet(f"{base}/again").first()["value"])["transaction_id"] == "1"


@pytest.mark.parametrize("how", [["--writer", "w"], ["--writer", "w", "--buckets", "3"]])
def test_jobs_that_count_batches_once(spark, files, how):  # noqa: F811
    raw, table = str(files / "raw"), str(files / "table")
    jobs.run(spark, ["publish-lines", "--csv", str(files / "csv"), "--output", raw, "--limit", "3"])
    command = ["enrich-csv", "--input", raw, "--output", table, "--rates", str(files / "rates"), "--max-bytes", "1"]
    command += ["--checkpoint", str(files / "check"), "--drain", "--stop-marker", str(files / "stop"), *how]
    streaming.request_stop(spark, str(files / "stop"))
    jobs.run(spark, command)
    assert not (files / "table" / "_commits").exists()
    streaming.withdraw_stop(spark, str(files / "stop"))
    for _ in range(2):
        jobs.run(spark, command)
    if "--buckets" in how:
        name = "table_" + "".join(c if c.isalnum() else "_" for c in table)
        rows = sinks.BucketedTable(name, table, 3).open(spark)
    else:
        rows = sinks.read_committed(spark, table)
    assert values(rows, "transaction_id") == [("1",), ("2",)]


@pytest.mark.parametrize(
    "more",
    [
        ["--forget-after", "1 hour", "--sole-writer"],
        ["--forget-after", "1 hour", "--writer", "w"],
        ["--buckets", "3"],
    ],
)
def test_options_that_would_store_ids_twice_are_refused(spark, files, more):  # noqa: F811
    command = ["enrich-csv", "--input", str(files / "csv"), "--input-format", "text", "--output", str(files / "t")]
    command += ["--rates", str(files / "rates"), "--drain", "--checkpoint", str(files / "check"), *more]
    with pytest.raises(SystemExit, match="--"):
        jobs.run(spark, command)


def test_forgotten_ids_are_still_stored_once(spark, rates, payload):
    """An id in many deliveries, kept a second: the table is asked each time."""
    folder, add = message_folder(spark, [payload(transaction_id="1")])
    for _ in range(4):
        add(payload(transaction_id="1"))
    path = scratch_path(spark, "table")
    for _ in range(2):
        rows = plans.enrich_json(
            stream_of(spark, folder, max_files_per_trigger=1), rates, forget_after="1 millisecond"
        )
        streaming.start_batches(
            rows, streaming.parquet_sink(path), scratch_path(spark, "check"), drain=True
        ).awaitTermination()
    assert values(sinks.read_table(spark, path), "transaction_id") == [("1",)]
