"""Currency rates: units of each currency per US dollar, one row per currency."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, read_file, replace_file

RATES_DDL = "currency string, rate double"


def rates_from_mapping(spark: SparkSession, rates: Mapping[str, float]) -> DataFrame:
    """A rate table from a plain mapping, planned as a literal relation."""
    table = pa.table(
        {
            "currency": pa.array(list(rates), pa.string()),
            "rate": pa.array([float(rate) for rate in rates.values()], pa.float64()),
        }
    )
    return spark.createDataFrame(table)


def rates_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """A rate table from CSV files with a ``currency,rate`` header."""
    reader = spark.read.schema(RATES_DDL).option("header", True).option("enforceSchema", False)
    return reader.option("mode", "FAILFAST").csv(path)


def rates_from_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("currency", "rate")


class RateBook:
    """Versions of the rates on shared storage; a reader takes the one that is current.

    A version is named by a hash of its rows, so publishing equal rates again writes
    nothing. The current one is named by a small file that is replaced at once, so a
    micro-batch reads one version or the other, never parts of both.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def publish(self, rates: DataFrame) -> str:
        """Make ``rates`` current; the name of their version. A currency may come once."""
        rows = rates.select("currency", F.col("rate").cast("double").alias("rate"))
        marks = [F.xxhash64("currency", "rate"), F.xxhash64("rate", "currency")]
        sums = [F.sum(F.pmod(mark, F.lit(1 << 32))) for mark in marks]
        found = rows.agg(
            F.count("*"), F.count_distinct("currency"), F.count("currency"), *sums
        ).first()
        if found[1] < found[2] or found[0] - found[2] > 1:
            raise ValueError("the rate table lists a currency twice")
        version = "-".join(f"{value or 0:x}" for value in (found[0], *found[3:]))
        place = f"{self.path}/rates-{version}"
        if not path_exists(self.spark, f"{place}/_SUCCESS"):
            rows.write.mode("overwrite").parquet(place)
        if self.current() != version:
            replace_file(self.spark, f"{self.path}/current", version)
        return version

    def current(self) -> str | None:
        return read_file(self.spark, f"{self.path}/current")

    def rates(self) -> DataFrame:
        """The rates that are current now."""
        version = self.current()
        if version is None:
            raise ValueError(f"no rates were published to {self.path}")
        return self.spark.read.schema(RATES_DDL).parquet(f"{self.path}/rates-{version}")
