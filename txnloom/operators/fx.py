"""Currency conversion."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

# There are under 200 currency codes; a table past this many rows is not
# broadcast and takes the salted join instead.
MAX_BROADCAST_RATES = 10_000
_SALTS = 64
_RATE_KINDS = (pa.string(), pa.float64())

FX_MODES = ("divide", "multiply")


def _salted_left_join(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Left join that spreads each currency's rows over ``_SALTS`` shuffle keys.

    The salt hashes the row and its input task: a retried task places its rows
    alike, and equal rows of different tasks go to different places.
    """
    hashable = [F.col(name) for name, kind in df.dtypes if "map<" not in kind]
    spot = F.xxhash64(*hashable, F.spark_partition_id())
    salted = df.withColumn("_salt", F.pmod(spot, F.lit(_SALTS)).cast("int"))
    copies = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return salted.join(copies, ["currency", "_salt"], "left").drop("_salt")


def frozen_rates(rates: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The rates as they are now, and whether they are at most ``most``; a currency may come once.

    So few are held in the plan itself: rates from a mapping take no job and no file, others
    one read. More are kept in the shared scratch folder.
    """
    spark = rates.sparkSession
    kept = rates.select(F.col("currency"), F.col("rate").cast("double").alias("rate"))
    few = kept.limit(most + 1).collect()
    if len(few) <= most:
        doubled = len({row["currency"] for row in few}) < len(few)
        columns = [pa.array([row[i] for row in few], kind) for i, kind in enumerate(_RATE_KINDS)]
        kept = spark.createDataFrame(pa.table(columns, names=["currency", "rate"]))
    else:
        path = scratch_path(spark, "rates")
        kept.write.parquet(path)
        kept = spark.read.schema(kept.schema).parquet(path)
        doubled = not kept.groupBy("currency").count().where("count > 1").isEmpty()
    if doubled:
        raise ValueError("the rate table lists a currency twice")
    return kept, len(few) <= most


def join_currency(
    df: DataFrame, rates: DataFrame, max_broadcast_rates: int = MAX_BROADCAST_RATES
) -> DataFrame:
    """Left join ``rates(currency, rate)``; an unknown or null currency gets a null rate.

    Rows are never multiplied: a currency with two rates raises ``ValueError``. The
    rates are read once, here, and every batch joins those. Their number decides
    only how: within the bound they are broadcast, so neither the transactions nor
    any micro-batch shuffles for them.
    """
    kept, few = frozen_rates(rates, max_broadcast_rates)
    if few:
        return df.join(F.broadcast(kept), "currency", "left")
    return _salted_left_join(df, kept)


def usd_amount(
    df: DataFrame,
    rates: DataFrame,
    mode: str = "divide",
    max_broadcast_rates: int = MAX_BROADCAST_RATES,
) -> DataFrame:
    """Add ``rate_usd``, the amount in US dollars.

    Rates are units of the currency per dollar, so ``divide`` is the conversion.
    ``multiply`` gives the product that the JSON pipeline stores. A zero rate
    gives null when dividing.
    """
    if mode not in FX_MODES:
        raise ValueError(f"mode must be one of {FX_MODES}, not {mode!r}")
    joined = join_currency(df, rates, max_broadcast_rates)
    amount, rate = F.col("amount").cast("double"), F.col("rate")
    dollars = F.try_divide(amount, rate) if mode == "divide" else amount * rate
    return joined.withColumn("rate_usd", dollars).drop("rate")
