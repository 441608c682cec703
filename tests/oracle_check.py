"""Compare every query with its SQL: ``python -m tests.oracle_check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if Path(path).exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "~"
        return f"{type(value).__name__}:{value!r}"

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    frame = query(spark, sf_dir)
    got = canonical([tuple(row) for row in frame.collect()], frame.columns)
    answer = con.execute(sql)
    names = [column[0] for column in answer.description]
    want = canonical(answer.fetchall(), names)
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            off = [
                (column, a, b) for column, a, b in zip(sorted(names), mine, theirs) if a != b
            ]
            return f"first difference {off}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from txnloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    conf = {
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("oracle-check", "local[8]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, entry.oracle_sql()[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("all equal" if not bad else f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
