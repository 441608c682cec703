"""Time the pipelines and the main operators; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local
cores, ``BENCH_RUNS`` the runs per query, of which the fastest counts.
``as_written_json`` and ``as_written_csv`` run the same work in the order and
with the operators of the pipelines as first published: rates joined by sort and
merge, look-ahead splitting, de-duplication last.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from txnloom.operators import add_calendar, cast_fields, parse_json  # noqa: E402
from txnloom.schema import EVENT_TIME, FIELD_NAMES, VELOCITY  # noqa: E402
from txnloom.session import build_session, scratch_path  # noqa: E402
from workload import queries as q  # noqa: E402
from workload.tables import RATES, read_rows  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def staged_payloads(spark: SparkSession) -> dict[str, str]:
    """Write the payloads once, so that timings cover reading and enriching only."""
    rows = read_rows(spark, SF_DIR, "lineitem")
    paths = {}
    for name, payloads in (("json", q.json_payloads(rows)), ("csv", q.line_payloads(rows))):
        paths[name] = scratch_path(spark, f"bench-{name}")
        payloads.select("value").repartition(CPUS).write.parquet(paths[name])
    return paths


# Fixed value: a comma followed by an even number of double quotes.
COMMA_OUTSIDE_QUOTES = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def plain_tail(rows: DataFrame, spark: SparkSession, divide: bool) -> DataFrame:
    rates = spark.createDataFrame(list(RATES.items()), ["currency", "rate"])
    dated = add_calendar(rows, string_rule=True).drop(VELOCITY, EVENT_TIME)
    joined = dated.join(rates, on="currency", how="left")
    amount = F.col("amount") / F.col("rate") if divide else F.col("amount") * F.col("rate")
    return joined.withColumn("rate_usd", amount).drop("rate").dropDuplicates(["transaction_id"])


def as_written_csv(spark: SparkSession, payloads: DataFrame) -> DataFrame:
    fields = payloads.select(
        F.split(F.col("value").cast("string"), COMMA_OUTSIDE_QUOTES).alias("fields")
    )
    rows = fields.select(
        *(F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(FIELD_NAMES))
    )
    return plain_tail(cast_fields(rows), spark, divide=True)


def as_written_json(spark: SparkSession, payloads: DataFrame) -> DataFrame:
    text = payloads.select(F.col("value").cast("string").alias("value"))
    return plain_tail(parse_json(text, strict=True, velocity=True), spark, divide=False)


def fastest(make) -> float:
    """Seconds to compute every row and column, without collecting them."""
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        frame = make()
        frame.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return best


def main() -> None:
    from txnloom import plans
    from workload.tables import rates

    conf = {
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": str(CPUS),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{CPUS}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    paths = staged_payloads(spark)
    rows = spark.read.parquet(paths["json"]).count()

    def payloads(name: str) -> DataFrame:
        return spark.read.parquet(paths[name])

    cases = {
        "enrich_json": lambda: plans.enrich_json(payloads("json"), rates(spark)),
        "enrich_csv": lambda: plans.enrich_csv(payloads("csv"), rates(spark)),
        "as_written_json": lambda: as_written_json(spark, payloads("json")),
        "as_written_csv": lambda: as_written_csv(spark, payloads("csv")),
        "normalize_messages": lambda: plans.normalize_messages(payloads("json")),
    }
    for name in (
        "parse_csv_line",
        "cast_fields",
        "fx_divide",
        "dedup_transaction_id",
        "to_json_envelope",
        "to_line_envelope",
        "src_csv_header",
        "sink_foreach_batch",
        "sink_idempotent_append",
        "stream_enrich",
        "stream_dedup",
    ):
        cases[name] = lambda query=q.QUERIES[name]: query(spark, SF_DIR)
    seconds = {name: round(fastest(make), 3) for name, make in cases.items()}
    headline = seconds["enrich_json"] + seconds["enrich_csv"]
    as_written = seconds["as_written_json"] + seconds["as_written_csv"]
    print(
        json.dumps(
            {
                "metric": "enrich_json + enrich_csv wall time",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": CPUS,
                "rows_per_pipeline": rows,
                "rows_per_sec": round(2 * rows / headline),
                "as_written_sec": round(as_written, 3),
                "speedup_over_as_written": round(as_written / headline, 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
