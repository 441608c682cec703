"""Repeated three-line passages, found by overlapping windows over all documents.

Every three consecutive lines with a word among them are a window. Of equal windows the first, by
doc_id (nulls last), then text hash, then line, stays. Every line that a later one covers goes;
a line that also belongs to the first window itself, where the two overlap, stays.

Texts of fewer than three lines and null texts are left as they are. Rows of the same id and text
count as one place, so neither removes the other's lines; rows of the same id with different texts
are told apart by a hash of the text. Empty tables give no rows. Long texts are read whole; other columns
are passed on, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_slices
from .tokens import SPACE, Texts, run_hashes, windows

SIZE = 3


def line_windows(docs: DataFrame) -> DataFrame:
    """A row for each window: its hash, and the place (doc_id, text_key, line) where it starts."""

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts(batch.column(2))
        start, end, doc = texts.lines()
        hashes, at = windows(run_hashes(texts.data, start, end), doc, SIZE)
        filled = np.concatenate([[0], np.cumsum(~SPACE[texts.data])])
        some = filled[end[at + SIZE - 1]] > filled[start[at]]
        hashes, at = hashes[some], at[some]
        line = np.arange(len(start)) - np.searchsorted(doc, doc)
        rows = pa.array(doc[at])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(hashes.view(np.int64)),
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(line[at].astype(np.int32)),
            ],
            names=["passage", "doc_id", "text_key", "line"],
        )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    return map_slices(rows, compute, "passage long, doc_id long, text_key long, line int")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the line numbers that go, a row for each place with any."""
    found = line_windows(docs)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "line")
    first = found.groupBy("passage").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where("first != last").select("passage", "first")
    later = found.join(first, "passage").where(place > F.col("first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    start = F.when(same, F.greatest("line", F.col("first.line") + SIZE)).otherwise(F.col("line"))
    covered = later.select("doc_id", "text_key", F.explode(F.sequence(start, F.col("line") + SIZE - 1)).alias("gone"))
    return covered.groupBy("doc_id", "text_key").agg(F.collect_set("gone").alias("gone"))


def drop_repeated_lines(docs: DataFrame, n_lines: str | None = None, n_removed: str | None = None) -> DataFrame:
    """``docs`` with its columns, the text without the lines that go, and n_chars counted anew.

    ``n_lines`` and ``n_removed`` name columns for the counts, if wanted.
    """
    key_id, key_text, gone = (free_name(docs, n) for n in ("place_doc_id", "place_text_key", "place_gone"))
    marks = repeated_lines(docs).toDF(key_id, key_text, gone)
    text = F.col("text").cast("string")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key_id)) & (F.xxhash64(text) == F.col(key_text))
    joined = docs.join(marks, same, "left")
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.col(gone), i))
    out = {"text": F.when(F.col(gone).isNull(), text).otherwise(F.array_join(kept, "\n"))}
    if n_lines:
        out[n_lines] = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    if n_removed:
        out[n_removed] = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    changed = joined.withColumns(out)
    if "n_chars" in docs.columns:
        count = F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("text"))
        changed = changed.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return changed.drop(key_id, key_text, gone)


SQL = r"""
WITH d AS (
  SELECT doc_id, text, hash(text) AS k, row_number() OVER () AS r, string_split(text, chr(10)) AS ls FROM documents),
w AS (
  SELECT DISTINCT doc_id, k, i, list_slice(ls, i, i + 2) AS three FROM (
    SELECT doc_id, k, ls, unnest(range(1, greatest(coalesce(len(ls), 0) - 1, 1))) AS i FROM d) q),
o AS (
  SELECT doc_id, k, i, row_number() OVER p AS n, first_value(doc_id) OVER p AS fd, first_value(k) OVER p AS fk,
    first_value(i) OVER p AS fi
  FROM w WHERE regexp_matches(array_to_string(three, chr(10)), '[^\x20\x09-\x0D]')
  WINDOW p AS (PARTITION BY three ORDER BY doc_id NULLS LAST, k, i)),
g AS (
  SELECT DISTINCT doc_id, k, i + j AS line FROM o, (SELECT unnest([0, 1, 2]) AS j) js
  WHERE n > 1 AND NOT (doc_id IS NOT DISTINCT FROM fd AND k = fk AND i + j < fi + 3)),
x AS (
  SELECT doc_id, k, list(line) AS gone FROM g GROUP BY doc_id, k)
SELECT d.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(
    list_filter(list_transform(ls, lambda l, i: CASE WHEN list_contains(gone, i) THEN NULL ELSE l END),
      lambda l: l IS NOT NULL), chr(10)), '') END AS text
FROM d LEFT JOIN x ON d.doc_id IS NOT DISTINCT FROM x.doc_id AND d.k = x.k
"""
