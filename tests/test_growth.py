"""Queries that make files, buckets, scan tasks or streams make more of them as tables grow."""

from __future__ import annotations

from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.oracle_check import compare, connect
from txnloom.session import size_scan
from workload import queries
from workload.oracle import ORACLE

EVENTS = 240


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("grown")
    kinds = F.array(*(F.lit(k) for k in ("view", "purchase", "click", "signup", "error")))
    events = spark.range(EVENTS).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") * 977 + 1_704_067_200).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 90).alias("user_id"),
        kinds[(F.col("id") % 5).cast("int")].alias("event_type"),
        (F.col("id") % 400 / 2).alias("value"),
        F.format_string('{"k": %d}', "id").alias("props"),
    )
    pq.write_table(events.toArrow(), folder / "events.parquet")
    lines = spark.range(EVENTS).select(
        (F.col("id") % 70).alias("l_orderkey"),
        (F.col("id") % 31).alias("l_partkey"),
        (F.col("id") % 7).alias("l_suppkey"),
        (F.col("id") % 6 + 1).cast("int").alias("l_linenumber"),
        F.lit(3.0).alias("l_quantity"),
        (F.col("id") * 500.5).alias("l_extendedprice"),
        F.lit(0.04).alias("l_discount"),
        F.lit(0.05).alias("l_tax"),
        F.lit("A").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
        F.timestamp_seconds(F.hash("id").cast("long") % 100 * 864_000 + 800_000_000)
        .cast("timestamp_ntz")
        .alias("l_shipdate"),
    )
    pq.write_table(lines.toArrow(), folder / "lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["sink_redelivery", "graceful_stop", "stream_chain", "stream_earliest", "bucketed_append", "src_first_lines"],
)
def test_many_files_give_the_same_rows(spark, grown, monkeypatch, name):
    monkeypatch.setattr(queries, "FILE_ROWS", 30)
    queries.use_utc(spark)
    problem = compare(spark, connect(grown), name, getattr(queries, name), ORACLE[name], grown)
    assert problem is None


def test_copies_are_in_files_of_other_deliveries(spark, grown, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 30)
    folder, each = queries.message_files(spark, grown, 4)
    assert each == 4
    rows = spark.read.parquet(folder).select("value", F.col("_metadata.file_path").alias("file"))
    sizes = Counter(row["file"] for row in rows.collect())
    assert len(sizes) == 16 and sum(sizes.values()) == 2 * EVENTS and max(sizes.values()) < 70
    assert rows.groupBy("value").agg(F.count_distinct("file").alias("n")).where("n < 2").isEmpty()


def test_paced_files_are_dealt_to_streams(spark, grown, monkeypatch):
    monkeypatch.setattr(queries, "PACE", 20)
    monkeypatch.setattr(queries, "PACE_FILES", 4)
    rows = queries.paced_ingest(spark, grown).collect()
    assert [row["n_rows"] for row in rows] == [20] * (EVENTS // 20)


def test_scan_tasks_are_cut_by_rows(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "128m")
    path = str(tmp_path / "rows")
    spark.range(100_000).select(F.lit("same").alias("text")).write.parquet(path)
    assert size_scan(spark, path, rows=200_000, least=1) > size_scan(spark, path, rows=1_000, least=1)
    size = int(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    assert size == size_scan(spark, path, rows=1_000, least=1)
    assert size_scan(spark, path, rows=10**12) == 128 * 1024 * 1024
