"""Document rules whose failures are judged host by host.

Each document is measured once, in the task that reads it. Failures are summed by host, and the
failure rate of a host is shrunk towards all hosts by a beta prior fitted to them by moments, so
that a host of three pages isn't blocked for two bad ones. A host whose shrunk rate is over
``MAX_HOST_RATE`` is blocked with everything on it.

Nulls: a null text has no words and fails; documents without a host share one. Empty tables give
no rows; repeated rows are measured each for itself, long texts whole. Nothing is ranked, so there are
no ties. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, map_slices, saved
from .tokens import SPACE, Texts, run_hashes, windows, with_doc

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: More symbols than this for a hundred words are a failure.
MAX_SYMBOL_PERCENT = 10
MAX_HOST_RATE = 0.5
#: The prior's weight in documents lies between these.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(texts: Texts) -> list[np.ndarray]:
    docs = len(texts)
    start, end = texts.words()
    doc = texts.doc_of(start)
    letters = ~SPACE[texts.data]
    chars = texts.per_doc(letters & ((texts.data & 0xC0) != 0x80))

    first, last, line_doc = texts.lines()
    filled = np.concatenate([[0], np.cumsum(letters)])
    has_word = filled[last] > filled[first]
    lines = with_doc(run_hashes(texts.data, first[has_word], last[has_word]), line_doc[has_word])
    line_doc = line_doc[has_word]
    _, once = np.unique(lines, return_index=True)
    repeated_lines = np.bincount(line_doc, minlength=docs) - np.bincount(line_doc[once], minlength=docs)

    shingles, at = windows(run_hashes(texts.data, start, end), doc, 5)
    _, which, counts = np.unique(with_doc(shingles, doc[at]), return_inverse=True, return_counts=True)
    hit = at[counts[which] > 1]
    cover = np.zeros(len(start) + 6, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + 5, -1)
    covered = np.cumsum(cover)[: len(start)] > 0
    return [
        np.bincount(doc, minlength=docs),
        chars,
        texts.per_doc(SYMBOL[texts.data]),
        repeated_lines,
        np.bincount(doc[covered], minlength=docs),
    ]


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the five measures and which rules fail, a row for each document."""

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = _measure(Texts(batch.column(1)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), *(pa.array(c, pa.int64()) for c in counts)],
            names=["doc_id", "host", *MEASURES],
        )

    schema = "doc_id long, host string, " + ", ".join(f"{m} long" for m in MEASURES)
    rows = doc_columns(docs.withColumn(host, F.col(host).cast("string")), host)
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words")
    return map_slices(rows, compute, schema).withColumns(
        {"base_failed": (F.col("n_words") < MIN_WORDS) | repeats, "symbols_failed": symbols}
    )


def host_verdicts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunk) and host_blocked.

    The prior has the mean of the hosts' rates, and the weight that explains how far the rates
    differ beyond what samples of their size would.
    """
    failed = (F.col("base_failed") | F.col("symbols_failed")).cast("long")
    hosts = measured.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(failed).alias("n_failed"))
    hosts = saved(hosts, "hosts").withColumn("rate", F.col("n_failed") / F.col("n_docs"))
    mean, spread, part = hosts.agg(F.avg("rate"), F.var_pop("rate"), F.avg(1 / F.col("n_docs"))).first()
    mean, noise = mean or 0.0, (mean or 0.0) * (1 - (mean or 0.0))
    between = (spread or 0.0) - noise * (part or 0.0)
    weight = MOST_WEIGHT if between <= 0 else min(max(noise / between - 1, LEAST_WEIGHT), MOST_WEIGHT)
    rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.select("host", "n_docs", "n_failed", rate.alias("host_rate"), (rate > max_rate).alias("host_blocked"))


def host_quality(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures and verdict of every document; ``kept`` is false for a failure or a blocked host."""
    measured = saved(measure(docs, host), "measures")
    verdicts = host_verdicts(measured, max_rate).withColumnRenamed("host", "its_host")
    joined = measured.join(verdicts, F.col("host").eqNullSafe(F.col("its_host")), "left")
    kept = ~F.col("base_failed") & ~F.col("symbols_failed") & ~F.col("host_blocked")
    return joined.select("doc_id", *MEASURES, "base_failed", kept.alias("kept"), "host_blocked")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (
  SELECT r, i, list_slice(ws, i, i + 4) AS five FROM (
    SELECT r, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM w) q),
rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM g) q WHERE n > 1),
cov AS (
  SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) ks GROUP BY r),
ln AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM (
    SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) q
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(ln.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON cov.r = w.r LEFT JOIN ln ON ln.r = w.r),
f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    100 * n_symbols > 10 * n_words AS symbols_failed FROM m),
h AS (
  SELECT source, count(*) AS n, sum(CASE WHEN base_failed OR symbols_failed THEN 1 ELSE 0 END) AS k
  FROM f GROUP BY source),
p AS (
  SELECT avg(k / n) AS mean, var_pop(k / n) - avg(k / n) * (1 - avg(k / n)) * avg(1 / n) AS between_hosts
  FROM h),
v AS (
  SELECT mean, CASE WHEN between_hosts <= 0 THEN 1e6
    ELSE least(greatest(mean * (1 - mean) / between_hosts - 1, 1), 1e6) END AS weight FROM p),
b AS (
  SELECT source, (k + mean * weight) / (n + weight) > 0.5 AS host_blocked FROM h, v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT symbols_failed AND NOT host_blocked AS kept, host_blocked
FROM f JOIN b ON f.source IS NOT DISTINCT FROM b.source
"""
