"""Homomorphic multiset fingerprints: the sum, over a text's paragraphs, of wide hashed vectors.

A paragraph is what lies between line feeds. It is hashed into 16 identity lanes of 32 bits and 128
likeness lanes. Identity lanes are cut from a digest of its bytes. Likeness lanes add up a sign, +1 or
-1, for each different five-word run of the paragraph (all its words, if fewer). All lanes are summed
modulo 2**32, so the order of paragraphs plays no part and a paragraph is taken in or out by adding or
subtracting its vector, without the rest of the text.

Equal texts have equal fingerprints, and so have texts with the same paragraphs in another order; others
differ but for collisions of 512 bits. The likeness lanes of two texts differ by the signs of the runs
that only one of them has, so the inner product over the mean square estimates the share of common runs,
with a deviation of about 0.09 for unlike texts and less for like ones.

A null text is an empty one, which is one empty paragraph. Words are runs of bytes other than white space,
so every text counts whole and case matters. Long texts are hashed a part at a time.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_slices, slices
from .tokens import U64, Texts, distinct, mix, run_hashes, windows

IDENTITY, LIKENESS = 16, 128
LANES = IDENTITY + LIKENESS
SIZE = 5
#: Runs whose signs are held at once.
STEP = 1 << 15
#: Bytes of text that a chunk of neighbouring documents holds, and sampled keys for each chunk.
CHUNK_BYTES, OVERSAMPLE = 64 << 20, 4
LEAST = -(1 << 63)

_SEEDS = mix(np.arange(1, LIKENESS // 64 + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))


def vectors(column: pa.Array) -> np.ndarray:
    """The vector of each text, as rows of LANES unsigned 32-bit numbers."""
    texts = Texts(column)
    start, end, doc = texts.lines()
    out = np.zeros((len(texts), LANES), np.uint32)
    if not len(texts):
        return out
    data = texts.data.tobytes()
    digests = b"".join(blake2b(data[s:e]).digest() for s, e in zip(start.tolist(), end.tolist()))
    first = np.searchsorted(doc, np.arange(len(texts)))
    identity = np.frombuffer(digests, "<u4").reshape(-1, IDENTITY)
    out[:, :IDENTITY] = np.add.reduceat(identity, first, axis=0, dtype=np.uint32)

    runs, place = _runs(texts, start)
    owner = doc[place]
    total = np.zeros((len(texts), LIKENESS), np.int64)
    for at in range(0, len(runs), STEP):
        some, whose = runs[at : at + STEP], owner[at : at + STEP]
        signs = np.unpackbits(mix(some[:, None] + _SEEDS).astype("<u8").view(np.uint8).reshape(len(some), -1), axis=1)
        heads = np.flatnonzero(np.diff(whose, prepend=-1))
        counts = np.diff(np.append(heads, len(some)))
        sums = np.add.reduceat(signs, heads, axis=0, dtype=np.int64)
        total[whose[heads]] += 2 * sums - counts[:, None]
    out[:, IDENTITY:] = total.astype(np.uint32)
    return out


def _runs(texts: Texts, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different five-word runs of each paragraph, by paragraph; its only run if it has fewer words."""
    start, end = texts.words()
    line = np.searchsorted(lines, start, side="right") - 1
    words = run_hashes(texts.data, start, end)
    runs, at = windows(words, line, SIZE)
    where = line[at]
    count = np.bincount(line, minlength=len(lines))
    short = count[line] < SIZE
    if short.any():
        few, which = words[short], line[short]
        heads = np.flatnonzero(np.diff(which, prepend=-1))
        place = np.arange(len(few)) - np.repeat(heads, np.diff(np.append(heads, len(few))))
        whole = np.add.reduceat(mix(few + place.astype(np.uint64)), heads)
        runs, where = np.concatenate([runs, mix(whole)]), np.concatenate([where, which[heads]])
    return distinct(runs, where)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 0 to 1 for each pair of rows; 1 for equal vectors."""
    x, y = (v[:, IDENTITY:].astype(np.int32).astype(np.float64) for v in (a, b))
    square = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    share = np.divide(2 * (x * y).sum(axis=1), square, out=np.zeros(len(x)), where=square > 0)
    return np.where((a == b).all(axis=1), 1.0, np.clip(share, 0.0, 1.0))


def to_text(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes().hex() for row in rows.astype("<u4")], pa.string())


def from_text(fingerprints: pa.Array) -> np.ndarray:
    data = b"".join(bytes.fromhex(f) for f in fingerprints.to_pylist())
    return np.frombuffer(data, "<u4").reshape(-1, LANES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint of each row's text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = to_text(vectors(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "fingerprint"])

    return map_slices(rows, compute, "doc_id long, fingerprint string")


def updated(known: DataFrame, changes: DataFrame) -> DataFrame:
    """``known`` (doc_id, fingerprint) after paragraphs come (times > 0) or go (times < 0).

    ``changes`` has doc_id, paragraph and times. Lanes are summed like any other column, before and after
    the shuffle, so one document may have any number of changes. A document not known yet starts from no
    paragraph; ids are taken to be distinct, and rows without an id are left out.
    """

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lanes = vectors(part.column(1)).astype(np.int64) * np.asarray(part.column(2), np.int64)[:, None]
                lanes %= 1 << 32
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, lanes.T.copy())], names=["doc_id", *names])

    names = [f"lane_{i}" for i in range(LANES)]
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names)
    rows = changes.where("times != 0 and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("paragraph").cast("string").alias("text"),
        F.col("times").cast("long").alias("times"),
    )
    # a lane is below 2**32, so 2**31 changes fit a long
    sums = rows.mapInArrow(weigh, schema).groupBy("doc_id").agg(*(F.sum(n).alias(n) for n in names))
    pieces = [F.pmod(n, F.lit(1 << 32)) for n in names]
    change = sums.select("doc_id", F.array(*pieces).alias("change"))
    before = known.where("doc_id is not null").select("doc_id", "fingerprint")
    joined = before.join(change, "doc_id", "full")
    lanes = F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), _lane(F.col("fingerprint")))
    none = F.array_repeat(F.lit(0).cast("long"), LANES)
    summed = F.zip_with(
        F.when(F.col("fingerprint").isNotNull(), lanes).otherwise(none),
        F.coalesce("change", none),
        lambda a, b: _lane_text(F.pmod(a + b, F.lit(1 << 32))),
    )
    return joined.select("doc_id", F.array_join(summed, "").alias("fingerprint"))


def _lane(fingerprint: Column):
    """The number of lane ``i``, whose four bytes are written lowest first."""

    def number(i: Column) -> Column:
        pairs = [F.substring(fingerprint, i * 8 + 2 * k + 1, F.lit(2)) for k in (3, 2, 1, 0)]
        return F.conv(F.concat(*pairs), 16, 10).cast("long")

    return number


def _lane_text(value: Column) -> Column:
    text = F.lpad(F.lower(F.hex(value)), 8, "0")
    return F.concat(*(F.substring(text, 2 * k + 1, 2) for k in (3, 2, 1, 0)))


def neighbours(docs: DataFrame) -> DataFrame:
    """Documents in chunks of descending doc_id: chunk, ghost, doc_id, text, sorted in each task.

    Every chunk is followed by a ghost, a copy of the document that comes next, so a task that reads
    its chunks in order sees each document with its successor. After the last document comes the first.
    Chunks are cut at sampled documents, so their sizes follow the data; the sample decides nothing else.
    Equal ids are ordered by a hash of the text; null ids come after all others.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumns({"rank": F.coalesce("doc_id", F.lit(LEAST)), "mark": F.xxhash64("text")})
    size = rows.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"),
                    F.max(F.struct("rank", "mark")).alias("first")).first()
    spark = docs.sparkSession
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size["bytes"] or 0) // CHUNK_BYTES)
    share = max(1, (size["rows"] or 0) // (chunks * OVERSAMPLE))
    sample = rows.where(F.pmod(F.xxhash64("rank", "mark"), F.lit(share)) == 0).select("rank", "mark").collect()
    keys = sorted({tuple(key) for key in sample})[::OVERSAMPLE]
    if size["first"] is not None:
        keys = sorted({*keys, tuple(size["first"])})

    @F.pandas_udf("chunk long, ghost long")
    def placed(rank: pd.Series, mark: pd.Series) -> pd.DataFrame:
        found = [bisect_left(keys, key) for key in zip(rank.tolist(), mark.tolist())]
        heads = [key == keys[at] for at, key in zip(found, zip(rank.tolist(), mark.tolist()))]
        # the largest of a chunk follows the chunk above it; the largest of all follows the smallest
        ghost = [(at + 1) % len(keys) if head else -1 for at, head in zip(found, heads)]
        return pd.DataFrame({"chunk": found, "ghost": ghost})

    rows = rows.withColumn("placed", placed("rank", "mark"))
    own = F.struct(F.col("placed.chunk").alias("chunk"), F.lit(False).alias("ghost"))
    copy = F.struct(F.col("placed.ghost").alias("chunk"), F.lit(True).alias("ghost"))
    copies = F.array_compact(F.array(own, F.when(F.col("placed.ghost") >= 0, copy)))
    rows = rows.select(F.explode(copies).alias("at"), "doc_id", "text", "rank", "mark")
    rows = rows.select("at.chunk", "at.ghost", "doc_id", "text", "rank", "mark").repartition("chunk")
    ordered = rows.sortWithinPartitions("chunk", "ghost", F.desc("rank"), F.desc("mark"))
    return ordered.select("chunk", "ghost", "doc_id", "text")


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like they and its successor's are.

    The edit replaces the last floor(n_chars / 2) code points by the first as many of the next document.
    One row for each row of ``docs``; equal rows are each other's neighbours. An empty table gives no rows.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the document that still waits for its successor
        for batch in batches:
            for part in slices(batch):
                part = pa.Table.from_batches([part])
                if last is not None:
                    part = pa.concat_tables([last, part])
                part = part.combine_chunks()
                if len(part) > 1:
                    yield _compared(part)
                last = part.slice(len(part) - 1)

    return neighbours(docs).mapInArrow(compare, RESULT)


def _compared(rows: pa.Table) -> pa.RecordBatch:
    """Every row but ghosts and the last, each with the row below it."""
    ghost = np.asarray(rows["ghost"])
    texts = [text or "" for text in rows["text"].to_pylist()]
    at = np.flatnonzero(~ghost[:-1])
    own = vectors(rows["text"].combine_chunks())
    half = [len(texts[i]) // 2 for i in at]
    edited = [texts[i][: len(texts[i]) - h] + texts[i + 1][:h] for i, h in zip(at, half)]
    changed = vectors(pa.array(edited, pa.large_string()))
    return pa.RecordBatch.from_arrays(
        [
            rows["doc_id"].combine_chunks().take(pa.array(at)),
            pa.array([len(texts[i]) for i in at], pa.int64()),
            pa.array([sha256(text.encode()).hexdigest() for text in edited], pa.string()),
            to_text(own[at]),
            to_text(changed),
            pa.array(likeness(own[at], changed)),
            pa.array(likeness(own[at], own[at + 1])),
        ],
        names=[field.strip().split()[0] for field in RESULT.split(",")],
    )
