"""Table contract, idempotent appends, layout, message envelopes."""

from __future__ import annotations

import json
from unittest import mock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from txnloom import plans, sinks
from txnloom.schema import FIELD_NAMES, TARGET, TARGET_NAMES, conform, ddl
from txnloom.session import scratch_path
from txnloom.sources import JdbcTarget
from workload.queries import _event_target, twice


def target_rows(spark, *ids, day=1):
    base = spark.createDataFrame([(i,) for i in ids], "transaction_id string")
    return conform(
        base.withColumns(
            {
                name: F.lit(day if name == "day" else 1 if kind == "int" else None)
                for name, kind in TARGET
                if name != "transaction_id"
            }
        )
    )


def test_contract_has_28_typed_columns(spark):
    rows = target_rows(spark, "1")
    assert len(TARGET_NAMES) == 28
    assert rows.dtypes == list(TARGET)
    assert rows.columns[-6:] == ["year", "month", "day", "hour", "minute", "rate_usd"]
    with pytest.raises(AnalysisException):
        conform(rows.drop("rate_usd"))


def test_table_is_created_once(spark):
    path, name = scratch_path(spark, "t"), "contract_table"
    sinks.create_table(spark, name, path)
    sinks.write_partitioned(target_rows(spark, "1"), path)
    sinks.create_table(spark, name, path)
    spark.catalog.recoverPartitions(name)
    assert spark.table(name).count() == 1
    assert dict(spark.table(name).dtypes) == dict(TARGET)
    spark.sql(f"DROP TABLE {name}")


def test_appending_again_adds_nothing(spark):
    path = scratch_path(spark, "t")
    sinks.append_new(target_rows(spark, "1", "2", "2"), path)
    sinks.append_new(target_rows(spark, "2", "3", day=2), path)
    sinks.append_new(target_rows(spark, "1", "3", day=3), path, unique=True)
    assert values(sinks.read_table(spark, path), "transaction_id", "day") == [
        ("1", 1),
        ("2", 1),
        ("3", 2),
    ]


def test_a_null_id_fails_the_append_and_leaves_the_table(spark):
    path = scratch_path(spark, "t")
    sinks.append_new(target_rows(spark, "1"), path)
    with pytest.raises(Exception, match="transaction_id is null"):
        sinks.append_new(target_rows(spark, "2", None), path)
    assert values(sinks.read_table(spark, path), "transaction_id") == [("1",)]


def test_ids_are_broadcast_only_within_the_bound(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    batch, table = target_rows(spark, "1", "2", "3"), target_rows(spark, "2", "9")
    small = sinks.keep_unseen(batch, table)
    for large in (
        sinks.keep_unseen(batch, table, max_rows=2),
        sinks.keep_unseen(batch, table, max_bytes=2),
    ):
        assert "Broadcast" not in plan_of(large) and "LeftAnti" in plan_of(large)
        assert values(large, "transaction_id") == [("1",), ("3",)]
    assert "LeftSemi" in plan_of(small) and "SortMergeJoin" not in plan_of(small)
    assert values(small, "transaction_id") == [("1",), ("3",)]


def test_lookup_prunes_folders_and_skips_by_id(spark, sf_dir):
    path = scratch_path(spark, "t")
    sinks.write_partitioned(_event_target(spark, sf_dir), path)
    found = sinks.lookup(spark, path, year=2024, month=1, day=5, transaction_id="150")
    plan = plan_of(found)
    assert "(day#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "EqualTo(transaction_id,150)" in plan
    whole = sinks.read_table(spark, path)
    assert values(found) == values(
        whole.where("year = 2024 and month = 1 and day = 5 and transaction_id = '150'")
    )
    assert values(sinks.lookup(spark, path)) == values(whole)


def test_a_heavy_day_is_written_by_many_tasks_over_disjoint_ids(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    ids = spark.range(4000).select(F.col("id").cast("string").alias("transaction_id"))
    rows = conform(
        ids.crossJoin(target_rows(spark, "0").drop("transaction_id")).withColumn(
            "day", F.when(F.col("transaction_id") < "9", F.lit(1)).otherwise(F.lit(2))
        )
    )
    path = scratch_path(spark, "t")
    sinks.write_partitioned(rows, path, disjoint=True)
    files = (
        spark.read.parquet(path)
        .where("day = 1")
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.min("transaction_id").alias("low"), F.max("transaction_id").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(files) > 1
    assert all(a["high"] < b["low"] for a, b in zip(files, files[1:]))


def test_the_number_of_ranges_can_be_fixed(spark):
    rows = target_rows(spark, *(str(i) for i in range(100)))
    path = scratch_path(spark, "t")
    sinks.append_new(rows, path, ranges=3)
    assert len(spark.read.parquet(path).inputFiles()) == 3


def test_json_envelope_writes_nulls_and_keeps_other_alphabets(spark):
    df = spark.createDataFrame([("é", None, 12.0)], "a string, b string, c double")
    row = plans.json_envelope(df).first()
    assert (row["key"], row["value"]) == ("Transaction", '{"a":"é","b":null,"c":12.0}')
    assert plans.json_envelope(df, key_column="a").first()["key"] == "é"


def test_published_row_is_typed(spark, payload):
    text = dict.fromkeys(FIELD_NAMES, "x") | {
        "amount": "2",
        "distance_from_home": "12.5",
        "card_present": "TRUE",
        "high_risk_merchant": "maybe",
        "transaction_hour": "3",
    }
    df = spark.createDataFrame([text], ", ".join(f"{n} string" for n in FIELD_NAMES))
    sent = json.loads(plans.publish_json(df).first()["value"])
    assert list(sent) == list(FIELD_NAMES)
    assert (sent["amount"], sent["distance_from_home"]) == (2.0, 12.5)
    assert sent["transaction_hour"] == "3"
    assert sent["card_present"] is True and sent["high_risk_merchant"] is False


def test_line_envelope_strips(spark):
    df = spark.createDataFrame([(" \ta,b \r\n",)], "value string")
    assert tuple(plans.line_envelope(df).first()) == ("Transaction", "a,b")


def test_normalized_message_changes_only_the_timestamp(spark, payload):
    sent = payload(timestamp="2024-09-30 00:00:01.034820+02:00", velocity_last_hour="{'n': 1}")
    df = spark.createDataFrame([("k", sent)], "key string, value string")
    row = plans.normalize_messages(df).first()
    want = sent.replace("2024-09-30 00:00:01.034820+02:00", "2024-09-29T22:00:01.034Z")
    assert row["key"] == "k" and row["value"] == want
    odd = [
        '{"extra" : "x",  "timestamp":  "2024-09-30T00:00:01Z","transaction_hour":3, "v":{"n":1.0}}',
        '{"timestamp":"30/09/2024","amount":12.0}',
        '{"a":{"timestamp":"2024-09-30T00:00:01Z"}}',
    ]
    got = [r["value"] for r in plans.normalize_messages(spark.createDataFrame([(o,) for o in odd], "value string")).collect()]
    assert got == [odd[0].replace("01Z", "01.000Z"), odd[1], odd[2]]
    twice = '{"timestamp":"2024-09-30T00:00:01Z","in":{"timestamp":"t"},"other":"x"}'
    again = plans.normalize_messages(spark.createDataFrame([(twice,)], "value string")).first()["value"]
    assert json.loads(again) == json.loads(twice) | {"timestamp": "2024-09-30T00:00:01.000Z"}
    assert plans.normalize_messages(df, "customer_id").first()["key"] == "x"
    assert plans.normalize_messages(df.drop("key")).first()["key"] == "Transaction"


@pytest.mark.parametrize(
    "junk", ["not json", '{"transaction_id": "1", "amount":', "5", "[]", "{}", "", "é\n", None]
)
def test_normalizing_passes_on_what_is_not_json(spark, payload, junk):
    df = spark.createDataFrame([("k", junk), ("k", payload())], "key string, value string")
    got = [row["value"] for row in plans.normalize_messages(df).collect()]
    assert got[0] == junk and json.loads(got[1])["transaction_id"] == "t1"


def test_kafka_publish_needs_its_connector(spark):
    assert sinks.kafka_write_options("k:9093", "out") == {
        "kafka.bootstrap.servers": "k:9093",
        "topic": "out",
    }
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(AnalysisException, match="kafka"):
        sinks.publish(df, "k:9093", "out")


class FakeDatabase:
    """Stands in for JDBC reads and writes; no database runs here."""

    def __init__(self, spark, stored):
        self.spark, self.stored, self.tables, self.calls = spark, stored, {}, []

    def write(self, writer, url, table, mode=None, properties=None):
        self.calls.append((table, mode))
        self.tables[table] = values(writer._df, "transaction_id")

    def read(self, reader, url, table, **options):
        self.calls.append((table, "read"))
        held = [row for row in next(v for k, v in self.tables.items() if "incoming" in k and k in table) if row[0] in self.stored]
        return self.spark.createDataFrame(held, "transaction_id string")


def test_jdbc_append_skips_ids_the_table_holds(spark):
    database = FakeDatabase(spark, {"2"})
    target = JdbcTarget("jdbc:x", table="t")
    with (
        mock.patch(
            "pyspark.sql.readwriter.DataFrameWriter.jdbc",
            lambda writer, *a, **k: database.write(writer, *a, **k),
        ),
        mock.patch(
            "pyspark.sql.readwriter.DataFrameReader.jdbc",
            lambda reader, *a, **k: database.read(reader, *a, **k),
        ),
    ):
        sinks.append_new_jdbc(target_rows(spark, "1", "2", "3"), target)
        assert database.tables["t"] == [("1",), ("3",)]
        assert [call[1] for call in database.calls] == ["overwrite", "read", "append"]
        assert "JOIN t_incoming" in database.calls[1][0]
        database.calls.clear()
        sinks.append_new_jdbc(target_rows(spark, "2"), target, writer="csv")
        assert [call[0] for call in database.calls if call[1] == "overwrite"] == ["t_incoming_csv"]
        database.calls.clear()
        sinks.append_new_jdbc(target_rows(spark, "1"), target, check_existing=False)
        assert database.calls == [("t", "append")]
        with pytest.raises(Exception, match="transaction_id is null"):
            sinks.append_new_jdbc(target_rows(spark, "1", None), target)


def test_jdbc_table_statements():
    create, index = sinks.table_statements("t")
    assert create.startswith("CREATE TABLE IF NOT EXISTS t (transaction_id TEXT PRIMARY KEY, ")
    assert create.count(",") == 27 and "amount FLOAT, " in create and "hour INT, " in create
    assert index.endswith("ON t (transaction_id, year, month, day)")
    spark = mock.Mock()
    sinks.create_table_jdbc(spark, JdbcTarget("jdbc:x", table="t"))
    assert [call.args for call in spark.read.option.call_args_list] == [
        ("sessionInitStatement", create),
        ("sessionInitStatement", index),
    ]


def test_whole_table_twice_is_stored_once(spark, sf_dir):
    path = scratch_path(spark, "t")
    rows = _event_target(spark, sf_dir)
    for _ in range(2):
        sinks.append_new(twice(rows), path)
    assert values(sinks.read_table(spark, path)) == values(rows)
    assert ddl(TARGET).count(",") == 27
