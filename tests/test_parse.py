"""Payload decoding, including rows whose tokens do not match the declared types."""

from __future__ import annotations

import pytest

from tests.conftest import values
from txnloom import operators as op
from txnloom.schema import FIELD_NAMES, VELOCITY


def frame(spark, *payloads):
    return spark.createDataFrame([(p,) for p in payloads], "value string")


def first(df, *columns):
    return tuple(df.select(*columns).first())


def test_binary_payload_is_utf8_text(spark):
    df = spark.createDataFrame([(bytearray("é,1", "utf-8"),)], "value binary")
    assert op.payload_to_string(df).first()["value"] == "é,1"


def test_strict_json_nulls_only_the_mismatched_field(spark, payload):
    def strict(field, token):
        return first(
            op.parse_json(frame(spark, payload(**{field: token})), strict=True, velocity=True),
            field,
            "merchant",
        )

    assert strict("distance_from_home", 12.0) == (None, "x")
    assert strict("distance_from_home", 12) == (12, "x")
    assert strict("transaction_hour", "3") == (None, "x")
    assert strict(VELOCITY, "{'n': 1}") == (None, "x")
    assert strict(VELOCITY, {"n": 1}) == ({"n": "1"}, "x")
    assert strict("amount", "1.5") == (None, "x")
    assert strict("is_fraud", "true") == (None, "x")


def test_default_json_reads_and_casts_mismatched_fields(spark, payload):
    text = payload(distance_from_home=12.0, transaction_hour="3", amount="1.5", is_fraud="true")
    parsed = op.parse_json(frame(spark, text), velocity=True)
    assert first(
        parsed, "distance_from_home", "transaction_hour", "amount", "is_fraud", VELOCITY
    ) == (12, 3, 1.5, True, {"n": "1"})
    assert VELOCITY not in op.parse_json(frame(spark, text)).columns


@pytest.mark.parametrize("strict", [True, False])
def test_payloads_that_are_not_json_give_rows_of_nulls(spark, payload, strict):
    df = frame(spark, "not json", None, payload())
    parsed = op.parse_json(df, strict=strict)
    assert parsed.count() == 3
    assert values(parsed, "transaction_id", "amount") == [("t1", 2.0), (None, None), (None, None)]


def test_rejected_json_keeps_the_original_text(spark, payload):
    whole = payload()
    cut_short = whole[:-1]
    df = frame(spark, "not json", None, whole, cut_short, payload(transaction_id=None))
    parsed = op.parse_json(df, strict=True)
    rejected = op.rejected_json(df)
    assert rejected.count() == parsed.where("transaction_id is null").count()
    assert ("not json",) in values(rejected) and (whole,) not in values(rejected)


def test_csv_line_by_position(spark, payload):
    line = payload("csv", merchant='"A, ""q"" é"')
    parsed = op.parse_csv_line(frame(spark, line))
    assert parsed.columns == list(FIELD_NAMES)
    assert first(parsed, "merchant", "is_fraud") == ('"A, ""q"" é"', "False")
    unquoted = op.parse_csv_line(frame(spark, line), unquote=True)
    assert first(unquoted, "merchant", "is_fraud") == ('A, "q" é', "False")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_short_and_long_csv_lines(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    parsed = op.cast_fields(op.parse_csv_line(frame(spark, "a,b", ",".join("x" * 30))))
    assert values(parsed, "transaction_id", "customer_id", "amount", "device") == [
        ("a", "b", None, None),
        ("x", "x", None, "x"),
    ]


def test_cast_and_strict_coercion_differ_on_junk_booleans(spark, payload):
    df = op.parse_csv_line(
        frame(
            spark,
            payload("csv", transaction_id="1", card_present="maybe", distance_from_home="12.7"),
            payload("csv", transaction_id="2", card_present="y", distance_from_home="12"),
        )
    )
    assert values(op.cast_fields(df), "transaction_id", "card_present", "distance_from_home") == [
        ("1", None, 12),
        ("2", True, 12),
    ]
    assert values(op.coerce_strict(df), "transaction_id", "card_present", "distance_from_home") == [
        ("1", False, 12.7),
        ("2", False, 12.0),
    ]


def test_wire_json_keeps_token_types_and_named_columns(spark, payload):
    df = spark.createDataFrame([("k", payload(transaction_hour="3"))], "key string, value string")
    parsed = op.parse_wire_json(df, keep=("key",))
    assert first(parsed, "key", "distance_from_home", "transaction_hour", "timestamp") == (
        "k",
        12.0,
        "3",
        "2024-09-30T05:00:01.999Z",
    )
