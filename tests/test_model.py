"""Both paths, from CSV file to table, against a row-at-a-time Python model.

The model uses the standard library only: ``csv`` to read, ``json`` to encode,
``datetime`` for time, ``struct`` for 32-bit money. Rows are random, with quotes,
commas, other alphabets, repeated ids, unknown currencies and odd numbers.
"""

from __future__ import annotations

import csv
import io
import json
import random
import re
import struct
from datetime import datetime, timedelta, timezone

import pytest

from tests.conftest import values
from txnloom import plans, sources
from txnloom.schema import FIELD_NAMES, TARGET_NAMES
from workload.tables import RATES

WORDS = ['plain', 'a, b', 'say "hi"', '"', 'né, "ñ" 東京', "it's", ' padded ', '', 'x""y', "{'k': 1}"]
FLAGS = ("card_present", "high_risk_merchant", "weekend_transaction", "is_fraud")
NUMBERS = ("amount", "distance_from_home")


def random_rows(seed, count=400):
    """Rows of text; those that share an id are equal, so that either may survive."""
    pick = random.Random(seed)
    start = datetime(2023, 12, 31, 20, tzinfo=timezone.utc)
    rows = {}
    for _ in range(count):
        moment = start + timedelta(microseconds=pick.randrange(10**13))
        offset = timezone(timedelta(hours=pick.choice((0, -5, 2, 5))))
        row = {name: pick.choice(WORDS) for name in FIELD_NAMES}
        row |= {
            "transaction_id": f"T{len(rows)}",
            "timestamp": moment.astimezone(offset).isoformat(sep=pick.choice("T ")),
            "amount": pick.choice(("0", "294.87", "1e2", str(round(pick.uniform(0, 9999), 2)))),
            "currency": pick.choice((*RATES, "ZZZ", "")),
            "distance_from_home": pick.choice(("0", "12", "12.7", "3.0")),
            "transaction_hour": str(pick.randrange(24)),
        }
        row |= {flag: pick.choice(("True", "false", "TRUE", "no", "1", "junk")) for flag in FLAGS}
        rows[row["transaction_id"]] = row
    copies = list(rows.values()) + pick.choices(list(rows.values()), k=count // 3)
    pick.shuffle(copies)
    return copies


@pytest.fixture(params=[1, 2, 3])
def transactions(request, tmp_path):
    rows = random_rows(request.param)
    text = io.StringIO()
    writer = csv.DictWriter(text, FIELD_NAMES, lineterminator="\n")
    writer.writeheader()
    writer.writerows(rows)
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "rows.csv").write_text(text.getvalue(), encoding="utf-8")
    return str(folder), rows, text.getvalue()


def float32(number):
    return struct.unpack("f", struct.pack("f", number))[0]


def published(row):
    return row | {
        **{name: float(row[name]) for name in NUMBERS},
        **{flag: row[flag].lower() == "true" for flag in FLAGS},
    }


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def utc(text):
    return EPOCH + (datetime.fromisoformat(text) - EPOCH)


def normalized(message):
    since = (utc(message["timestamp"]) - EPOCH) // timedelta(milliseconds=1)
    day, millis = EPOCH.date() + timedelta(days=since // 86_400_000), since % 86_400_000
    hour, minute, second = millis // 3_600_000, millis // 60_000 % 60, millis // 1000 % 60
    return message | {"timestamp": f"{day}T{hour:02d}:{minute:02d}:{second:02d}.{millis % 1000:03d}Z"}


def stored(row, moment, amount, dollars, hours):
    distance, hour = hours
    known = row | {
        "amount": amount,
        "distance_from_home": distance,
        "transaction_hour": hour,
        "year": moment.year,
        "month": moment.month,
        "day": moment.day,
        "hour": moment.hour,
        "minute": moment.minute,
        "rate_usd": dollars,
    }
    return tuple(known[name] for name in TARGET_NAMES)


def ordered(rows):
    return sorted(set(rows), key=lambda row: tuple((v is None, str(v)) for v in row))


def test_published_and_normalized_messages(spark, transactions):
    folder, rows, _ = transactions
    messages = plans.publish_json(sources.csv_rows(spark, folder))
    sent = [json.loads(row["value"]) for row in messages.collect()]
    key = lambda message: json.dumps(message, sort_keys=True)
    assert sorted(sent, key=key) == sorted(map(published, rows), key=key)
    fixed = [json.loads(row["value"]) for row in plans.normalize_messages(messages).collect()]
    assert sorted(fixed, key=key) == sorted(map(normalized, map(published, rows)), key=key)


@pytest.mark.parametrize("strict", [True, False])
def test_json_path(spark, rates, transactions, strict):
    folder, rows, _ = transactions
    messages = plans.normalize_messages(plans.publish_json(sources.csv_rows(spark, folder)))
    want = []
    for row in map(published, rows):
        amount = float32(row["amount"])
        rate = RATES.get(row["currency"])
        hours = (None, None)
        if not strict:
            hours = (int(row["distance_from_home"]), int(row["transaction_hour"]))
        dollars = None if rate is None else amount * rate
        want.append(stored(row, utc(row["timestamp"]), amount, dollars, hours))
    assert values(plans.enrich_json(messages, rates, strict=strict)) == ordered(want)


@pytest.mark.parametrize("string_rule", [True, False])
def test_csv_path(spark, rates, transactions, string_rule):
    folder, _, text = transactions
    lines = plans.line_envelope(sources.text_lines(spark, folder))
    truth = dict.fromkeys(("true", "1"), True) | dict.fromkeys(("false", "no"), False)
    want = []
    for line in text.strip().split("\n")[1:]:
        cells = re.findall(r'((?:[^",]|"[^"]*")*)(?:,|$)', line)[: len(FIELD_NAMES)]
        row = dict(zip(FIELD_NAMES, cells))
        amount = float32(float(row["amount"]))
        rate = RATES.get(row["currency"])
        row |= {flag: truth.get(row[flag].lower()) for flag in FLAGS}
        moment = utc(row["timestamp"])
        if string_rule:
            written = datetime.fromisoformat(row["timestamp"])
            moment = written.replace(hour=moment.hour, minute=moment.minute)
        hours = (int(float(row["distance_from_home"])), int(row["transaction_hour"]))
        dollars = None if rate is None else amount / rate
        want.append(stored(row, moment, amount, dollars, hours))
    assert values(plans.enrich_csv(lines, rates, string_rule=string_rule)) == ordered(want)
