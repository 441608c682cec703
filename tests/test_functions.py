"""Text and time expressions against plain Python on edge rows and random text."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnloom import functions as fn


def run(spark, texts, expression):
    rows = [(i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, v string").coalesce(1)
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def by_rule(line):
    """Cut at each comma with an even number of quotes after it."""
    fields, quotes = [""], line.count('"')
    for c in line:
        quotes -= c == '"'
        if c == "," and quotes % 2 == 0:
            fields.append("")
        else:
            fields[-1] += c
    return fields


LINES = [
    'a,"x, y",3,,',
    "",
    ",",
    "a,b,c",
    '"a,b',
    'a"b,c"d"e,f',
    'x,"A, ""q"" é",z',
    'l\n,"a,b",c',
    ',,",",,',
    'a,\x1e1,"b,\x1e0"\x1e,\x1e',
    '\x1e"1,2',
]


def test_split_keeps_quotes_and_empty_fields(spark):
    got = run(spark, LINES, fn.split_csv_line)
    assert got[0] == ["a", '"x, y"', "3", "", ""]
    assert got[6] == ["x", '"A, ""q"" é"', "z"]
    assert got == [by_rule(line) for line in LINES]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet='ab01,," \n\x1eé', max_size=30), min_size=30, max_size=60))
def test_split_equals_the_look_ahead(spark, lines):
    assert run(spark, lines, fn.split_csv_line) == [by_rule(line) for line in lines]


def test_split_of_many_quotes(spark):
    """A line that a look-ahead recurses on, one call for each quoted piece."""
    for lead in ("", '"'):
        line = lead + 'a,"x,y",' * 50_000 + "\n,"
        (got,) = run(spark, [line], fn.split_csv_line)
        assert got == by_rule(line)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="ab \t\r\n\x0b\x1f\xa0 　é", max_size=12), min_size=30))
def test_strip_equals_python(spark, texts):
    assert run(spark, texts, fn.strip) == [text.strip() for text in texts]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_do_not_depend_on_ansi(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    texts = ["12.7", " 12 ", "-3.9", ".5", "1e3", "12d", "99999999999", "abc", "", None]
    assert run(spark, texts, fn.to_int) == [12, 12, -3, 0, None, None, None, None, None, None]
    assert run(spark, ["1.5", "x", None], fn.to_float) == [1.5, None, None]
    flags = ["True", "y", "1", "t", "false", "n", "0", "maybe", "", None]
    assert run(spark, flags, fn.to_bool) == [True] * 4 + [False] * 3 + [None] * 3
    assert run(spark, flags, fn.is_literal_true) == [True] + [False] * 8 + [None]


@pytest.mark.parametrize("bad", ["x", "", None])
def test_strict_number_fails_the_job(spark, bad):
    assert run(spark, ["1.5", "2"], lambda c: fn.strict_double(c, "amount")) == [1.5, 2.0]
    with pytest.raises(Exception, match="amount is not a number"):
        run(spark, [bad], lambda c: fn.strict_double(c, "amount"))


NORMAL = {
    "2024-09-30 00:00:01.034820+00:00": "2024-09-30T00:00:01.034Z",
    "2024-09-30T00:00:01.999999-05:00": "2024-09-30T05:00:01.999Z",
    "2024-09-30 00:00:01": "2024-09-30T00:00:01.000Z",
    "2024-12-31T23:30:00-05:00": "2025-01-01T04:30:00.000Z",
    "1969-12-31T23:59:59.9995+00:00": "1969-12-31T23:59:59.999Z",
    "zzz": None,
    "12:30": None,
    "T12:30:00": None,
}


def test_normalized_text(spark):
    got = run(spark, list(NORMAL), lambda c: fn.utc_millis_text(fn.to_instant(c)))
    assert got == list(NORMAL.values())


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Europe/Madrid"])
def test_normalized_text_in_zones_with_clock_changes(spark, conf, zone):
    """Offsets win over the session zone, also in hours its clocks skip or repeat."""
    conf("spark.sql.session.timeZone", zone)
    texts = [
        f"2024-{month:02d}-{day:02d}T{hour:02d}:30:00.123456+00:00"
        for month, day in ((3, 10), (3, 31), (10, 27), (11, 3))
        for hour in range(9)
    ]
    want = [text[: len("2024-03-10T00:30:00.123")] + "Z" for text in texts]
    assert run(spark, texts, lambda c: fn.utc_millis_text(fn.to_instant(c))) == want


def test_naive_text_is_session_local(spark, conf):
    conf("spark.sql.session.timeZone", "America/New_York")
    texts = ["2024-07-01 00:00:00", "2024-12-01 00:00:00"]
    got = run(spark, texts, lambda c: fn.utc_millis_text(fn.to_instant(c)))
    assert got == ["2024-07-01T04:00:00.000Z", "2024-12-01T05:00:00.000Z"]
