"""The physical plans: one shuffle, rates broadcast, repeats pruned before the shuffle."""

from __future__ import annotations

import re

import pytest

from tests.conftest import plan_of
from txnloom import operators as op
from txnloom import plans, sinks, streaming
from txnloom.schema import VELOCITY
from txnloom.session import scratch_path
from workload import queries as q
from workload.tables import read_rows

PIPELINES = ("enrich_json", "enrich_csv")


@pytest.mark.parametrize("name", PIPELINES)
def test_one_shuffle_on_the_id_and_broadcast_rates(spark, sf_dir, name):
    plan = plan_of(q.QUERIES[name](spark, sf_dir))
    assert re.findall(r" Exchange (\w+)\(", plan) == ["hashpartitioning"]
    assert "Exchange hashpartitioning(transaction_id" in plan
    assert len(re.findall("BroadcastHashJoin", plan)) == 1 and "SortMergeJoin" not in plan
    rates = plan[plan.index("BroadcastExchange") :]
    assert "LocalTableScan [currency" in rates


@pytest.mark.parametrize("name", PIPELINES)
def test_repeats_are_pruned_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(q.QUERIES[name](spark, sf_dir))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", plan)]
    shuffle = plan.index("Exchange hashpartitioning")
    assert len(limits) == 2 and limits[0] < shuffle < limits[1]


def test_the_velocity_field_is_not_decoded(spark, rates):
    payloads = spark.createDataFrame([("{}",)], "value string")
    plan = plan_of(plans.enrich_json(payloads, rates))
    assert "StructField(is_fraud" in plan and f"StructField({VELOCITY}" not in plan


@pytest.mark.parametrize(
    "step",
    [op.parse_json, op.parse_csv_line, op.rejected_json, op.rejected_csv, plans.normalize_messages],
)
def test_payload_steps_do_not_shuffle(spark, sf_dir, step):
    payloads = op.payload_to_string(q.json_payloads(read_rows(spark, sf_dir, "events")))
    assert "Exchange" not in plan_of(step(payloads))


def test_json_is_decoded_once_per_row(spark, sf_dir, rates):
    payloads = q.json_payloads(read_rows(spark, sf_dir, "events"))
    enriched = plans.enrich_json(payloads, rates, with_id_only=True)
    assert plan_of(enriched.where("country is not null")).count("from_json(") == 1


def test_csv_is_split_once_per_row(spark, sf_dir, rates):
    lines = q.line_payloads(read_rows(spark, sf_dir, "events"))
    enriched = plans.enrich_csv(lines, rates, with_id_only=True)
    plan = plan_of(enriched.where("country is not null"))
    assert plan.count("AS fields#") == 1
    assert plan.count("CASE WHEN NOT Contains(value") == 1


def test_bulk_append_moves_rows_once_by_id_and_once_into_ranges(spark, sf_dir, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = q.enrich_csv(spark, sf_dir)
    path = scratch_path(spark, "table")
    sinks.write_partitioned(q._event_target(spark, sf_dir), path)
    written = []
    monkeypatch.setattr(
        "txnloom.sinks.parquet.write_partitioned", lambda df, _, **more: written.append(df)
    )
    sinks.append_new(rows, path, unique=True, bulk=True)
    plan = plan_of(written[0])
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    # One for the rows, kept from the de-duplication, and one for the table's ids.
    assert plan.count("Exchange hashpartitioning(transaction_id") == 2
    assert plan.count("CASE WHEN NOT Contains(value") == 1


def test_instant_is_parsed_once_per_row(spark, sf_dir):
    plan = plan_of(op.add_calendar(q.offset_rows(spark, sf_dir)))
    assert plan.count("try_cast(timestamp") == 1


def test_stream_keeps_ids_only_and_broadcasts_rates(spark, sf_dir, rates):
    rows = read_rows(spark, sf_dir, "events", streaming=True)
    query = streaming.start_files(
        plans.enrich_csv(q.line_payloads(rows), rates),
        scratch_path(spark, "out"),
        scratch_path(spark, "check"),
        drain=True,
    )
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "StreamingDeduplicate [transaction_id" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    state = query.lastProgress["stateOperators"][0]
    assert state["operatorName"] == "dedupe" and state["numRowsTotal"] == rows_in(spark, sf_dir)
    assert "rocksdbCommitCheckpointLatency" in state["customMetrics"]


def rows_in(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").count()
