"""Reading tables, shared intermediate tables and small checks, used by every operator here."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnloom.session import scratch_path

#: Bytes of text that one numpy step works on.
SLICE_BYTES = 1 << 21
#: Labels that are sent to every task, at most.
BROADCAST_LABELS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, computed once and kept in the cluster's shared scratch folder."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_columns(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long, ``text`` as string and further columns; everything else is left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *(F.col(name) for name in more),
    )


def remainder(column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; a null id has the remainder -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts, F.lit(-1))


def labelled(
    labels: DataFrame, label: str, parts: int, held: int, bound: int | None = None
) -> DataFrame:
    """All labelled ids outside the held-out part, with their label as 0 or 1.

    Rows without id or label are left out; an id labelled twice counts once, as 1 if any row
    says so. Beyond a ``bound``, if given, the ids with the smallest hash are taken.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
    rows = rows.where("doc_id is not null and label is not null")
    rows = rows.where(remainder("doc_id", parts) != held)
    rows = rows.groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    return rows if bound is None else rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def with_labels(
    docs: DataFrame, known: DataFrame, parts: int, held: int, most: int = BROADCAST_LABELS
) -> DataFrame:
    """The documents, by ``doc_columns``, that ``known`` labels, with its other columns.

    Up to ``most`` labels are sent to every task; beyond, texts outside the held-out part are
    shuffled by id.
    """
    few = known.count() <= most
    rows = doc_columns(docs).where(remainder("doc_id", parts) != held)
    return rows.join(F.broadcast(known) if few else known.hint("shuffle_merge"), "doc_id")


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Runs of rows holding about SLICE_BYTES of text; a longer text has a run of its own."""
    at = batch.schema.get_field_index(column)
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(sizes)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def map_slices(df: DataFrame, compute: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str):
    """Apply ``compute`` to slices of each Arrow batch of ``df``, whose text column is ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield compute(part)

    return df.mapInArrow(run, schema)


def filter_slices(df: DataFrame, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``df``, all columns as they are, for which ``keep`` of the texts is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                at = part.schema.get_field_index("text")
                yield part.filter(pa.array(keep(part.column(at)), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a one-variable logistic fit, slightly regularised, by Newton steps."""
    a = b = 0.0
    if weight.sum() == 0:
        return a, b
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([(weight * (y - p)).sum() - 1e-3 * a, (weight * (y - p) * x).sum() - 1e-3 * b])
        v = weight * p * (1 - p)
        h = np.array([[v.sum() + 1e-3, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
    return float(a), float(b)
