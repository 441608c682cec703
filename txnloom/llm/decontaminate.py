"""Benchmark items in documents, found with a budget of edits.

An item of m characters may differ in ``budget(m)`` of them. It is cut into one piece more than
that; by the pigeonhole principle one piece of any occurrence within the budget is unchanged. One
automaton finds all pieces of a block of items in a single pass over a text, and each hit is
verified around its place by Myers' bit-parallel edit distance. Letters are compared in lower case.

Items are numbered in Spark in blocks of bounded size, each block one pass over the documents, so a
benchmark of any size can be used. Nulls and empty items are left out, equal items of one id count
once; a null text has no hits. Of occurrences of one item in a text the one with the least distance is
given, of those the first. Repeated rows are searched each for itself, long texts whole; empty tables
give no rows. Other columns are passed on by ``drop_leaks`` and not read by ``leaks``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnloom.session import scratch_path

from .common import doc_columns, filter_slices, free_name, map_slices, saved

#: Share of an item's characters that may be edited.
ERROR_RATE = 0.1
#: Characters of benchmark text that one pass searches for.
BLOCK_CHARS = 2_000_000

Item = tuple[int, str]


def budget(m: int) -> int:
    return int(m * ERROR_RATE)


def fold(text: str) -> str:
    """Lower case, where that keeps every character at its place."""
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def pieces(text: str, count: int) -> list[tuple[int, str]]:
    """``count`` consecutive pieces of nearly equal length that make up the text, with their places."""
    edges = [i * len(text) // count for i in range(count + 1)]
    return [(a, text[a:b]) for a, b in zip(edges, edges[1:])]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(pattern: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and the first end with it.

    The column of the dynamic program is kept as two bit vectors of its vertical steps up and down.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        same = pattern.get(c, 0)
        across = (((same & up) + up) ^ up) | same
        rise = down | (full & ~(across | up))
        fall = up & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            if score < best:
                best, end = score, j
        rise, fall = rise << 1 & full, fall << 1 & full
        same |= down
        up = fall | (full & ~(same | rise))
        down = rise & same
    return best, end


def ascents(edges: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each piece the longer stretches that hold it, (start, end, budget), shortest first.

    A stretch of j pieces has the budget j - 1. If neither half of a stretch kept to its own
    budget, the stretch would have at least j edits; so an occurrence of the whole item within its
    budget has a piece all of whose stretches keep to theirs.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(edges) - 1)]

    def halve(low: int, high: int) -> None:
        if high - low > 1:
            middle = (low + high) // 2
            halve(low, middle)
            halve(middle, high)
            for piece in range(low, high):
                out[piece].append((edges[low], edges[high], high - low - 1))

    halve(0, len(edges) - 1)
    return out


class Searcher:
    """Searches texts for a block of items."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items = items
        self.masks: dict[tuple[int, int, int], dict[str, int]] = {}
        found: dict[str, list[tuple[int, int, list]]] = {}
        for n, (_, text) in enumerate(items):
            parts = pieces(text, budget(len(text)) + 1)
            above = ascents([at for at, _ in parts] + [len(text)])
            for (at, piece), stretches in zip(parts, above):
                found.setdefault(piece, []).append((n, at, stretches))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if items:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, distance) of the best occurrence of each item within its budget."""
        if not self.items:
            return []
        text = fold(text)
        starts: dict[int, set[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for n, at, stretches in where:
                place = last + 1 - size - at
                if self._holds(text, n, place, stretches[:-1]):
                    starts.setdefault(n, set()).add(place)
        out = []
        for n, places in starts.items():
            best = self._best(text, n, sorted(places))
            if best:
                out.append((self.items[n][0], *best))
        return sorted(out)

    def _mask(self, n: int, a: int, b: int) -> dict[str, int]:
        if (n, a, b) not in self.masks:
            self.masks[n, a, b] = masks(self.items[n][1][a:b])
        return self.masks[n, a, b]

    def _holds(self, text: str, n: int, place: int, stretches: list[tuple[int, int, int]]) -> bool:
        """Whether every stretch around a piece is there within its own budget."""
        for a, b, k in stretches:
            around = text[max(place + a - k, 0) : max(place + b + k, 0)]
            if len(around) < b - a - k or myers(self._mask(n, a, b), b - a, around)[0] > k:
                return False
        return True

    def _best(self, text: str, n: int, places: list[int]) -> tuple[int, int, int] | None:
        item = self.items[n][1]
        m, k = len(item), budget(len(item))
        for place in places:
            if place >= 0 and text.startswith(item, place):
                return place, place + m, 0
        if not k:
            return None
        found, back = [], masks(item[::-1])
        covered = -1 - m - k
        for i, place in enumerate(places):
            if place <= covered:
                continue
            # places of one occurrence differ by its edits; they share one verification
            covered = place
            for other in places[i + 1 :]:
                if other > covered + 2 * k:
                    break
                covered = other
            low = max(place - k, 0)
            distance, end = myers(self._mask(n, 0, m), m, text[low : max(covered + m + k, 0)])
            if distance <= k:
                high = low + end
                tail = text[max(high - m - k, 0) : high][::-1]
                _, length = myers(back, m, tail)
                found.append((distance, high - length, high))
        if not found:
            return None
        distance, start, end = min(found)
        return start, end, distance


def blocked_items(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, int]:
    """item_id, text and block of the different items, kept in the scratch folder, and the number of blocks.

    Blocks are numbered in Spark, by a hash, so that each holds about ``block_chars`` characters.
    """
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = saved(rows.where("item_id is not null and length(text) > 0").distinct(), "items")
    blocks = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars)
    return rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))), blocks


def _block(items: DataFrame, block: int) -> list[Item]:
    """The items of one block, folded: all that the driver and a task hold of the benchmark at once."""
    rows = items.where(F.col("block") == block).select("item_id", "text").toArrow().to_pylist()
    return sorted((row["item_id"], fold(row["text"])) for row in rows)


NAMES = ["doc_id", "item_id", "start", "end", "distance"]
SCHEMA = ", ".join(f"`{name}` long" for name in NAMES)


def _searched(docs: DataFrame, items: list[Item]) -> DataFrame:
    cache: list[Searcher] = []

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            cache.append(Searcher(items))
        rows = [
            (doc_id, *hit)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if text
            for hit in cache[0].search(text)
        ]
        columns = list(zip(*rows)) or [()] * len(NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)

    return map_slices(docs, compute, SCHEMA)


def leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, start, end (characters) and distance of each item found in each document.

    With several blocks, the hits of each are written before the next block is read.
    """
    spark, docs = docs.sparkSession, doc_columns(docs)
    items, blocks = blocked_items(benchmark, block_chars)
    if blocks == 0:
        return spark.createDataFrame([], SCHEMA)
    if blocks == 1:
        return _searched(docs, _block(items, 0))
    path = scratch_path(spark, "leaks")
    for block in range(blocks):
        _searched(docs, _block(items, block)).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item within its budget."""
    items, blocks = blocked_items(benchmark, block_chars)
    if blocks > 1:
        # a hash of the text stands for its row: equal texts hold equal items
        key = F.xxhash64(F.col("text").cast("string"))
        found = leaks(docs.select(key.alias("doc_id"), "text"), benchmark, block_chars)
        name = free_name(docs, "leak_key")
        gone = saved(found.select(F.col("doc_id").alias(name)).distinct(), "leaking")
        kept = docs.where("text is null")
        return docs.where("text is not null").join(gone, key == F.col(name), "left_anti").union(kept)
    if blocks == 0:
        return docs
    found = _block(items, 0)
    cache: list[Searcher] = []

    def clean(column: pa.Array) -> np.ndarray:
        if not cache:
            cache.append(Searcher(found))
        return np.array([not (t and cache[0].search(t)) for t in column.to_pylist()], bool)

    return filter_slices(docs, clean)
