"""Calendar, currency and de-duplication rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from txnloom import operators as op
from txnloom.operators.dedup import keep_first
from txnloom.schema import CALENDAR

ONE_INSTANT = {
    "2024-09-30 00:00:01.034820+00:00": (2024, 9, 30, 0, 0),
    "2024-09-30T00:00:01.999999-05:00": (2024, 9, 30, 5, 0),
    "2024-09-30 00:00:01": (2024, 9, 30, 0, 0),
    "2024-12-31T23:30:00-05:00": (2025, 1, 1, 4, 30),
    "zzz": (None,) * 5,
}
AS_WRITTEN = ONE_INSTANT | {"2024-12-31T23:30:00-05:00": (2024, 12, 31, 4, 30)}


@pytest.mark.parametrize("string_rule, want", [(False, ONE_INSTANT), (True, AS_WRITTEN)])
def test_calendar_of_text(spark, string_rule, want):
    df = spark.createDataFrame([(t,) for t in want], "timestamp string")
    got = op.add_calendar(df, string_rule=string_rule)
    assert got.columns == ["timestamp", *CALENDAR]
    assert {row[0]: tuple(row)[1:] for row in got.collect()} == want


def test_calendar_of_a_timestamp_ignores_the_string_rule(spark):
    text = "2024-12-31T23:30:00-05:00"
    df = spark.createDataFrame([(text,)], "t string").select(
        F.col("t").cast("timestamp").alias("timestamp")
    )
    for rule in (True, False):
        assert tuple(op.add_calendar(df, string_rule=rule).first())[1:] == (2025, 1, 1, 4, 30)


def money(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, amount float, currency string")


def test_dollar_amounts(spark, rates):
    df = money(spark, ("a", 294.87, "EUR"), ("b", 2.0, "EUR"))
    assert values(op.usd_amount(df, rates), "id", "rate_usd") == [
        ("a", 336.99428013392856),
        ("b", 2.2857142857142856),
    ]
    assert values(op.usd_amount(df, rates, "multiply"), "id", "rate_usd")[0] == (
        "a",
        258.01124572753906,
    )
    with pytest.raises(ValueError, match="mode"):
        op.usd_amount(df, rates, "add")


@pytest.mark.parametrize("bound", [10_000, 2])
def test_unknown_and_null_currencies_keep_their_rows(spark, rates, bound):
    df = money(spark, ("a", 1.0, "ZZZ"), ("b", 1.0, None), ("c", 3.0, "USD"), ("c", 3.0, "USD"))
    joined = op.join_currency(df, rates, max_broadcast_rates=bound)
    assert joined.columns[0] == "currency"
    assert values(joined, "id", "rate") == [("a", None), ("b", None), ("c", 1.0), ("c", 1.0)]


def test_zero_rate_gives_null_when_dividing(spark):
    zero = spark.createDataFrame([("EUR", 0.0)], "currency string, rate double")
    assert op.usd_amount(money(spark, ("a", 1.0, "EUR")), zero).first()["rate_usd"] is None


@pytest.mark.parametrize("bound", [10_000, 1])
def test_a_currency_listed_twice_is_refused(spark, bound):
    double = spark.createDataFrame([("EUR", 1.0), ("EUR", 2.0)], "currency string, rate double")
    with pytest.raises(ValueError, match="twice"):
        op.join_currency(money(spark, ("a", 1.0, "EUR")), double, max_broadcast_rates=bound)


def test_large_rate_tables_are_not_broadcast_by_hint(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = spark.range(50).select(
        F.concat(F.lit("C"), "id").alias("currency"), (F.col("id") + 1.0).alias("rate")
    )
    hot = spark.range(2000).select(
        F.col("id").cast("string").alias("id"),
        F.col("id").cast("float").alias("amount"),
        F.when(F.col("id") < 1500, F.lit("C7")).otherwise(F.lit("none")).alias("currency"),
    )
    joined = op.join_currency(hot, table, max_broadcast_rates=10)
    assert "BroadcastHashJoin" not in plan_of(joined)
    assert joined.groupBy("rate").count().orderBy("rate").collect() == [(None, 500), (8.0, 1500)]


def ids(spark, *rows):
    return spark.createDataFrame(
        list(rows), "transaction_id string, timestamp string, m map<string,string>, v int"
    )


def test_one_row_per_id_the_earliest(spark):
    df = ids(
        spark,
        ("1", "b", None, 1),
        ("1", "a", {"k": "v"}, 9),
        ("1", "a", None, 5),
        ("2", "z", None, 1),
        (None, "q", None, 1),
        (None, "p", None, 2),
    )
    assert values(op.drop_repeated_ids(df), "transaction_id", "timestamp", "v") == [
        ("1", "a", 5),
        ("2", "z", 1),
        (None, "p", 2),
    ]
    assert op.drop_repeated_ids(df).columns == df.columns


def test_survivor_does_not_depend_on_partitioning(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("hot"))
        .otherwise((F.col("id") / 4).cast("int").cast("string"))
        .alias("transaction_id"),
        (F.col("id") * 7919 % 1009).alias("timestamp"),
        F.col("id").alias("v"),
    )
    runs = [
        values(keep_first(df.repartition(n, F.rand(seed)))) for n, seed in ((1, 1), (7, 2), (3, 3))
    ]
    assert runs[0] == runs[1] == runs[2]
    best = {}
    for row in df.collect():
        rank = (row["timestamp"], row["v"])
        best[row["transaction_id"]] = min(best.get(row["transaction_id"], rank), rank)
    assert {row[0]: (row[1], row[2]) for row in runs[0]} == best


def test_key_alone(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,)], "transaction_id string")
    assert values(op.drop_repeated_ids(df)) == [("1",), (None,)]


@pytest.mark.parametrize("bound", [10_000, 1])
def test_rates_stay_as_they_were_when_planned(spark, tmp_path, bound):
    path = str(tmp_path / "rates")
    columns = "currency string, rate double"
    spark.createDataFrame([("EUR", 2.0), ("USD", 1.0)], columns).write.parquet(path)
    df = money(spark, ("a", 6.0, "EUR"), ("b", 6.0, "ZZZ"))
    planned = op.usd_amount(df, spark.read.parquet(path), max_broadcast_rates=bound)
    new = spark.createDataFrame([("EUR", 3.0), ("EUR", 4.0)], columns)
    new.write.mode("overwrite").parquet(path)
    assert values(planned, "id", "rate_usd") == [("a", 3.0), ("b", None)]


def test_lines_without_an_id_are_rejected(spark, payload):
    lines = [payload("csv"), payload("csv", transaction_id=" "), "", "   ", None, ",x", '"",x']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    bad = {None, "", "   ", ",x", lines[1]}
    assert {row[0] for row in op.rejected_csv(df).collect()} == bad
    assert {row[0] for row in op.rejected_csv(df, unquote=True).collect()} == bad | {'"",x'}
