"""Tables whose batches count once, tables bucketed by id, Bloom filters, and the earliest row of each id."""

from __future__ import annotations

import importlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from tests.test_sinks import target_rows
from txnloom import operators as op
from txnloom import sinks, streaming
from txnloom.schema import TARGET, TARGET_NAMES, conform
from txnloom.session import list_names, read_file, remove_file, replace_file, scratch_path


def ids(df):
    return [row[0] for row in values(df, "transaction_id")]


# ---------------------------------------------------------------- committed batches


def test_a_batch_delivered_again_replaces_its_rows(spark):
    path = scratch_path(spark, "t")
    assert sinks.read_committed(spark, path).count() == 0
    sinks.commit_batch(target_rows(spark, "1", "2"), path, "a", 0)
    sinks.commit_batch(target_rows(spark, "3"), path, "a", 1)
    sinks.commit_batch(target_rows(spark, "4", day=2), path, "a", 1)
    sinks.commit_batch(target_rows(spark, "9"), path, "b", 1)
    table = sinks.read_committed(spark, path)
    assert table.columns == list(TARGET_NAMES)
    assert ids(table) == ["1", "2", "4", "9"] and ids(table.where("day = 2")) == ["4"]
    assert len(sinks.unlisted(spark, path)) == 1


def test_a_batch_without_its_record_does_not_count(spark, monkeypatch):
    path = scratch_path(spark, "t")
    sinks.commit_batch(target_rows(spark, "1"), path, "a", 0)
    monkeypatch.setattr(importlib.import_module("txnloom.sinks.commits"), "replace_file", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sinks.commit_batch(target_rows(spark, "2"), path, "a", 1)
    assert ids(sinks.read_committed(spark, path)) == ["1"]
    with pytest.raises(Exception, match="transaction_id is null"):
        sinks.commit_batch(target_rows(spark, None), path, "a", 1)


def test_batches_are_compacted_but_the_last(spark):
    path = scratch_path(spark, "t")
    assert sinks.compact(spark, path, "a") is None
    for i in range(5):
        rows = target_rows(spark, str(i), day=1 + i % 2)
        sinks.commit_batch(rows.limit(0) if i == 2 else rows, path, "a", i)
        sinks.commit_batch(target_rows(spark, f"b{i}"), path, "b", i)
    assert sinks.compact(spark, path, "a") == 3
    assert sinks.commits(spark, path).where("writer = 'a'").count() == 2
    sinks.commit_batch(target_rows(spark, "4x"), path, "a", 4)
    sinks.commit_batch(target_rows(spark, "5"), path, "a", 5)
    want = ["0", "1", "3", "4x", "5", *(f"b{i}" for i in range(5))]
    assert ids(sinks.read_committed(spark, path)) == want
    assert sinks.compact(spark, path, "a") == 4 and sinks.compact(spark, path, "a") is None
    assert ids(sinks.read_committed(spark, path)) == want
    assert len(sinks.unlisted(spark, path)) == 7


def test_files_are_put_in_place_at_once(spark, tmp_path):
    path = f"{tmp_path}/deep/file"
    assert read_file(spark, path) is None
    for text in ("one é", "two"):
        replace_file(spark, path, text)
        assert read_file(spark, path) == text
    assert [n for n in list_names(spark, f"{tmp_path}/deep") if not n.startswith(".")] == ["file"]
    remove_file(spark, path)
    assert read_file(spark, path) is None


# ---------------------------------------------------------------- bucketed by id


@pytest.fixture
def table(spark):
    place = scratch_path(spark, "bucketed")
    table = sinks.BucketedTable("t_" + place.rpartition("-")[2], place, 4)
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def test_the_table_is_not_moved_to_find_stored_ids(spark, conf, table):
    conf("spark.sql.adaptive.enabled", "false")
    for i in range(3):
        table.append_new(target_rows(spark, *map(str, range(i, i + 30))), "a", i)
    batch = target_rows(spark, *map(str, range(40)))
    plan = plan_of(table.unseen(batch, table.open(spark), "a", 3))
    assert plan.count("Exchange") == 1 and "Broadcast" not in plan
    assert plan.index("Exchange") < plan.index("Bucketed: true") and "SelectedBucketsCount: 4 out of 4" in plan
    assert "Exchange" not in plan_of(table.unique_rows(spark))
    table.append_new(batch, "a", 3)
    assert sorted(map(int, ids(table.open(spark)))) == list(range(40))


def test_batches_of_two_writers_count_once(spark, table):
    table.append_new(target_rows(spark, "1", "2"), "a", 0)
    unseen = table.open(spark).limit(0)
    table.append_new(target_rows(spark, "2", "3"), "b", 0, stored=unseen)
    assert ids(table.open(spark)) == ["1", "2", "2", "3"]
    assert ids(table.unique_rows(spark)) == ["1", "2", "3"]
    for _ in range(2):
        table.append_new(target_rows(spark, "3", "4", "5"), "b", 1)
    table.append_new(target_rows(spark, "5", "6"), "b", 1)
    assert ids(table.unique_rows(spark)) == ["1", "2", "3", "5", "6"]
    with pytest.raises(Exception, match="transaction_id is null"):
        table.append_new(target_rows(spark, None), "b", 2)


def test_a_new_catalog_finds_the_table(spark, table):
    table.append_new(target_rows(spark, "1", "2"), "a", 0)
    spark.sql(f"DROP TABLE {table.name}")
    again = sinks.BucketedTable(table.name + "_again", table.path, table.buckets)
    again.append_new(target_rows(spark, "2", "3"), "a", 1)
    assert ids(again.open(spark)) == ["1", "2", "3"]
    spark.sql(f"DROP TABLE {again.name}")


# ---------------------------------------------------------------- layout


def scanned_rows(df):
    """Rows that the file scan gave, of a frame computed without adaptive execution."""
    plan = df._jdf.queryExecution().executedPlan()
    rows = df.collect()
    leaf = plan.collectLeaves().apply(0)
    return len(rows), leaf.metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups_that_bounds_can_not(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")
    rows = spark.range(20_000).select(F.sha1(F.col("id").cast("string")).alias("transaction_id"), (F.col("id") % 8 + 1).alias("d"))
    base = rows.crossJoin(target_rows(spark, "0").drop("transaction_id"))
    path = scratch_path(spark, "t")
    # every file has ids from 0... to f..., so bounds skip none
    sinks.write_partitioned(conform(base.withColumn("day", F.col("d"))), path)
    some = [rows.orderBy("transaction_id").collect()[i][0] for i in (1, 9_999)]
    for wanted, found in ((some[0], 1), ("0" * 40 + "x", 0), (some, 2)):
        got, read = scanned_rows(sinks.lookup(spark, path, transaction_id=wanted))
        assert got == found and read <= 3 * 2_500, (wanted, read)


def test_a_heavy_day_is_split_without_sampling(spark, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "20000")
    ids_ = spark.range(0, 20_000, 1, 8).select(F.sha1(F.col("id").cast("string")).alias("transaction_id"), "id")
    rest = {name: F.lit(1 if kind == "int" else None).cast(kind) for name, kind in TARGET if name != "transaction_id"}
    rows = ids_.withColumns(rest)
    day = F.when(F.col("id") < 19_990, 1).otherwise(F.col("id") - 19_988)
    path = scratch_path(spark, "t")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("heavy-day", "")
    sinks.write_partitioned(conform(rows.withColumn("day", day.cast("int"))), path)
    spark.sparkContext.setJobGroup("other", "")
    files = [name.split("/")[-2] for name in spark.read.parquet(path).inputFiles()]
    by_day = {int(day.removeprefix("day=")): n for day, n in Counter(files).items()}
    assert by_day[1] > 3 and all(n == 1 for d, n in by_day.items() if d != 1) and len(by_day) == 11
    assert len(jobs.getJobIdsForGroup("heavy-day")) <= 3


# ---------------------------------------------------------------- the earliest row of each id


def test_the_earliest_row_wins_whenever_it_comes(spark):
    rng = random.Random(4)
    for _ in range(3):
        path, seen = scratch_path(spark, "t"), []
        for batch in range(5):
            rows = [
                (rng.choice([None, "a", "b", "c", "d", "e"]), rng.choice(["2024-01-01 00:00:00", "2024-01-02 09:00:00", "bad", None]),
                 rng.randint(0, 3), rng.choice([1, 2, None]))
                for _ in range(rng.choice([0, 1, 4]))
            ]
            df = spark.createDataFrame(rows, "transaction_id string, timestamp string, v int, day int")
            for _ in range(rng.choice([1, 2])):
                sinks.merge_first(df, path, parts=("day",))
            seen += rows
            if seen:
                whole = spark.createDataFrame(seen, df.schema)
                got = spark.read.schema(df.schema).parquet(path).select(*df.columns)
                assert values(got) == values(op.keep_first(whole))


def test_only_folders_that_lose_a_row_are_written_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "transaction_id string, timestamp string, day int"
    put = lambda *rows: sinks.merge_first(spark.createDataFrame(list(rows), schema), path, parts=("day",))
    put(("a", "2024-01-05 00:00:00", 5), ("b", "2024-01-06 00:00:00", 6), ("c", "2024-01-07 00:00:00", 7))
    kept = {f.name for f in (tmp_path / "t" / "day=6").glob("*.parquet")}
    put(("a", "2024-01-01 00:00:00", 1), ("c", "2024-01-09 00:00:00", 9), ("b", "2024-01-06 00:00:00", 6))
    assert {f.name for f in (tmp_path / "t" / "day=6").glob("*.parquet")} == kept
    assert not (tmp_path / "t" / "day=5").exists() and not (tmp_path / "t" / "day=9").exists()
    assert values(spark.read.schema(schema).parquet(path), "transaction_id", "day") == [("a", 1), ("b", 6), ("c", 7)]


def test_sinks_by_name(spark):
    path = scratch_path(spark, "t")
    streaming.committed_sink(path, "w")(target_rows(spark, "1"), 0)
    assert ids(sinks.read_committed(spark, path)) == ["1"]
    with pytest.raises(ValueError, match="fx"):
        streaming.converting(lambda *a: None, None, "add")
