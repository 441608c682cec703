from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from txnloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(scratch),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def put(key, value):
        saved.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in saved.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def rates(spark):
    from workload.tables import RATES

    from txnloom.sources import rates_from_mapping

    return rates_from_mapping(spark, RATES)


@pytest.fixture
def payload():
    """A JSON or CSV payload builder with a filled-in transaction."""
    import json

    from txnloom.schema import FIELD_NAMES

    base = dict.fromkeys(FIELD_NAMES, "x") | {
        "transaction_id": "t1",
        "timestamp": "2024-09-30T05:00:01.999Z",
        "amount": 2.0,
        "currency": "EUR",
        "card_present": True,
        "distance_from_home": 12,
        "high_risk_merchant": False,
        "transaction_hour": 3,
        "weekend_transaction": False,
        "velocity_last_hour": {"n": 1},
        "is_fraud": False,
    }

    def build(fmt="json", **changes):
        row = base | changes
        if fmt == "json":
            return json.dumps(row, ensure_ascii=False)
        return ",".join("" if row[name] is None else str(row[name]) for name in FIELD_NAMES)

    return build


def values(df, *columns):
    """Collected rows as tuples, in a stable order."""
    rows = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
