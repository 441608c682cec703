"""Bytes covered by a 400-byte string that starts anywhere else, by sorted suffix names.

Suffixes are compared by names of their first bytes, and most through a sample of positions, as a
difference cover does; the sample here is chosen by content, so that equal strings have it at the
same places and one record stands for some thirty suffixes (README says why the positions aren't
taken modulo three).

1. Anchors: the least 64-byte name of each 337 positions. Every 400-byte string holds one, at the
   same place in each copy, so text farther from a repeated anchor than that has no repeats.
2. Sampled suffixes: a cut is a place whose 16 bytes before have a name divisible by 32. All starts
   with the same next cut are one interval. Intervals of equal context (all bytes their windows
   cover) get equal names; where a name occurs twice, every window of the interval is repeated.
3. Remaining suffixes: an interval that is alone with its context, but shares the bytes that all
   its windows have in common, lies at an edge of a repeat. It is cut into blocks of eight starts,
   which are told apart in the same way from the blocks of one interval of each context that has the
   same common bytes. Windows of blocks that are at an edge again are named one by one, and so are
   windows that have no cut near; a text sends each name once.

A null text is empty; texts under 400 bytes are left alone. Long texts are one row and one task's work,
in time in proportion; there are no ties to settle, as every copy goes. Other columns are not read. Repeated rows are documents of their
own, so all of a repeated row goes if it has 400 bytes. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, map_slices, saved
from .tokens import CODES, STEP, Texts, mix, powers

LENGTH = 400
ANCHOR = 64
GRAM, ONE_IN, NEAR = 16, 32, 192
BLOCK = 8
#: Places in texts that are sent to every task, at most; beyond, texts are shuffled.
BROADCAST_ROWS = 4_000_000

U64 = np.uint64
INVERSE = U64(pow(int(STEP), -1, 1 << 64))


class Names:
    """Names of any stretch of the bytes of one text."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        codes = CODES[data] * powers(n)[:n] if n else np.empty(0, np.uint64)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes)])
        self.unshift = inverse_powers(n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.unshift[start] + (end - start).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """The name of each stretch of ``size`` bytes."""
        n = max(len(self.total) - size, 0)
        return mix((self.total[size:] - self.total[:n]) * self.unshift[:n])


_inverse = np.cumprod(np.concatenate([[U64(1)], np.full((1 << 12) - 1, INVERSE)]))


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    while len(_inverse) < n:
        _inverse = np.concatenate([_inverse, _inverse * (_inverse[-1] * INVERSE)])
    return _inverse


def sliding(values: np.ndarray, size: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) of each run of ``size`` values."""
    span = 1
    while 2 * span <= size:
        values = of(values[:-span], values[span:])
        span *= 2
    return of(values[: len(values) - (size - span)], values[size - span :]) if size > span else values


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the anchors of one text."""
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    names = Names(data).every(ANCHOR)
    size = LENGTH - ANCHOR + 1
    least = sliding(names, size, np.minimum)
    pad = np.zeros(size - 1, np.uint64)
    at = np.flatnonzero(sliding(np.concatenate([pad, least, pad]), size, np.maximum) == names)
    return at, names[at]


def regions(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The stretches of a text of n bytes in which a window holds one of the places."""
    out: list[list[int]] = []
    for p in np.sort(places).tolist():
        low, high = max(p - (LENGTH - ANCHOR), 0), min(p + LENGTH, n)
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [(a, b) for a, b in out if b - a >= LENGTH]


def intervals(data: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int, int, int, bool]]:
    """(first start, last start, bytes from there to the cut's name, context, common, loose) of the
    starts of the windows in question."""
    names = Names(data)
    grams = names.every(GRAM)
    cuts = np.flatnonzero((grams >> U64(20)) % U64(ONE_IN) == 0) + GRAM  # the bytes before the cut
    out = []
    for low, high in regions(places, len(data)):
        starts = np.arange(low, high - LENGTH + 1)
        which = np.searchsorted(cuts, starts + GRAM)
        cut = np.concatenate([cuts, [1 << 60]])[which]
        loose = cut - GRAM - starts > NEAR
        edge = np.flatnonzero((which[1:] != which[:-1]) | (loose[1:] != loose[:-1])) + 1
        first = np.concatenate([[0], edge])
        last = np.concatenate([edge, [len(starts)]]) - 1
        a, b, free = starts[first], starts[last], loose[first]
        context = names.of(a, b + LENGTH)
        common = np.where(free, 0, cut[first] - GRAM)
        core = names.of(common, common + np.where(free, 0, LENGTH - NEAR))
        past = np.where(free, 0, common - b)
        columns = (a, b, past, context.view(np.int64), core.view(np.int64), free)
        out += zip(*(column.tolist() for column in columns))
    return out


def blocks(data: np.ndarray, low: np.ndarray, high: np.ndarray, past: np.ndarray) -> list[np.ndarray]:
    """The blocks of each interval: its number here, first start, last start, context, common.

    A block holds the starts whose distances to the cut's name differ only in their last bits, so
    equal windows are in blocks of the same place, and of the same common bytes.
    """
    names = Names(data)
    head, tail = past // BLOCK, (high + past - low) // BLOCK
    count = tail - head + 1
    which = np.repeat(np.arange(len(low)), count)
    nth = head[which] + np.arange(len(which)) - (np.cumsum(count) - count)[which]
    top = (high + past)[which] - BLOCK * nth
    a, b = np.maximum(low[which], top - BLOCK + 1), np.minimum(high[which], top)
    core = names.of(top, top + LENGTH - BLOCK + 1)
    return [which, a, b, names.of(a, b + LENGTH).view(np.int64), core.view(np.int64)]


def windows(data: np.ndarray, low: np.ndarray, high: np.ndarray, weight: np.ndarray) -> list[list[np.ndarray]]:
    """Name, start, end and weight of the windows of each interval, one of each name.

    Windows that this text has twice are known as repeated: their one row has weight 2, and rows of
    weight 0 say what they cover.
    """
    count = high - low + 1
    which = np.repeat(np.arange(len(low)), count)
    at = low[which] + np.arange(len(which)) - (np.cumsum(count) - count)[which]
    names, first, same, times = np.unique(
        Names(data).of(at, at + LENGTH), return_index=True, return_inverse=True, return_counts=True
    )
    again = np.unique(at[times[same] > 1])
    gap = np.flatnonzero(np.diff(again) > LENGTH) + 1
    start = again[np.concatenate([[0], gap])] if len(again) else again
    end = again[np.concatenate([gap, [len(again)]]) - 1] + LENGTH if len(again) else again
    none = np.zeros(len(start), np.int64)
    one = np.where(times > 1, 2, weight[which][first])
    return [[names.view(np.int64), at[first], at[first] + LENGTH, one], [none, start, end, none]]


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8"), np.uint8)


def _records(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """doc_key and the places of its repeated anchors."""

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, keys = Texts(batch.column(1)), batch.column(2).to_numpy()
        found = [anchors(texts.data[a:b]) for a, b in zip(texts.offsets, texts.offsets[1:])]
        counts = [len(p) for p, _ in found]
        empty = [np.empty(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([h.view(np.int64) for _, h in found] + empty)),
                pa.array(np.repeat(keys, counts), pa.int64()),
                pa.array(np.concatenate([p for p, _ in found] + empty)),
            ],
            names=["name", "doc_key", "place"],
        )

    rows = saved(map_slices(docs, compute, "name long, doc_key long, place long"), "anchors")
    twice = rows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    return rows.join(twice, "name").groupBy("doc_key").agg(F.collect_set("place").alias("places"))


def _told_apart(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """From rows (row_id, low, high, past, context, core, weight): stretches (row_id, start, end) of
    contexts that occur twice, and one of each context that lies at an edge or is needed there.

    A row of weight 2 stands for several, whose stretches are known.
    """
    one = F.min(F.struct("row_id", "low", "high", "past")).alias("one")
    classes = rows.groupBy("context").agg(F.sum("weight").alias("n"), one, F.min("core").alias("core"))
    classes = saved(classes, label)
    edges = classes.groupBy("core").agg(F.count("*").alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1")
    edge = classes.join(edges.select("core"), "core").select("one.*", F.least("n", F.lit(2)).alias("weight"))
    twice = classes.where("n > 1").select("context")
    whole = rows.where("weight = 1").select("context", "row_id", "low", "high").join(twice, "context")
    return whole.select("row_id", F.col("low").alias("start"), (F.col("high") + LENGTH).alias("end")), edge


def _beside(live: DataFrame, lists: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """Texts and the lists of their places, which are sent to the texts if they are few."""
    total = lists.agg(F.sum(F.size(column))).first()[0] or 0
    return live.join(F.broadcast(lists) if total <= BROADCAST_ROWS else lists, "row_id", how)


def _listed(df: DataFrame, names: list[str], label: str) -> DataFrame:
    """row_id and ``names`` as lists of equal order."""
    lists = df.groupBy("row_id").agg(F.collect_list(F.struct(*names)).alias("all"))
    return saved(lists.select("row_id", *(F.col(f"all.{name}").alias(name) for name in names)), label)


def _arrays(batch: pa.RecordBatch, names: list[str]):
    """row_id, the bytes of the text, and the lists of ``names`` as arrays, row by row."""
    for row, text, *lists in zip(*(batch.column(c).to_pylist() for c in ("row_id", "text", *names))):
        yield row, _bytes(text), *(np.array(values, np.int64) for values in lists)


def _columns(parts: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(column) for column in zip(*parts)] or [np.empty(0, np.int64)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _cover(live: DataFrame) -> DataFrame:
    """row_id and stretches (start, end) of repeated bytes of the live documents."""
    texts = live.select("row_id", "text")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            (row, *interval, 1)
            for row, text, places in zip(*(batch.column(c).to_pylist() for c in ("row_id", "text", "places")))
            for interval in intervals(_bytes(text), np.array(places, np.int64))
        ]
        kinds = [pa.int64()] * 6 + [pa.bool_(), pa.int64()]
        return _records(rows, ["row_id", "low", "high", "past", "context", "core", "loose", "weight"], kinds)

    schema = "row_id long, low long, high long, past long, context long, core long, loose boolean, weight long"
    rows = saved(map_slices(live.select("row_id", "text", "places"), cut, schema), "intervals")
    whole, edge = _told_apart(rows.where("not loose").drop("loose"), "contexts")

    names = ["low", "high", "past", "weight"]
    out = ["row_id", "low", "high", "past", "context", "core", "weight"]

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for row, data, low, high, past, weight in _arrays(batch, names):
            which, a, b, context, core = blocks(data, low, high, past)
            parts.append([np.full(len(a), row), a, b, np.zeros(len(a), np.int64), context, core, weight[which]])
        return _columns(parts, out)

    some = _beside(texts, _listed(edge, names, "edges"), "low")
    parts = saved(map_slices(some, split, ", ".join(f"{name} long" for name in out)), "blocks")
    more, edge = _told_apart(parts, "block-contexts")

    single = edge.drop("past").union(rows.where("loose").select("row_id", "low", "high", "weight"))

    def name(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for row, data, low, high, weight in _arrays(batch, ["low", "high", "weight"]):
            parts += [[c[0], np.full(len(c[1]), row), *c[1:]] for c in windows(data, low, high, weight)]
        return _columns(parts, ["name", "row_id", "start", "end", "weight"])

    some = _beside(texts, _listed(single, ["low", "high", "weight"], "singles"), "low")
    named = saved(map_slices(some, name, "name long, row_id long, start long, end long, weight long"), "windows")
    twice = named.where("weight > 0").groupBy("name").agg(F.sum("weight").alias("n")).where("n > 1").select("name")
    found = named.where("weight = 1").join(twice, "name").union(named.where("weight = 0"))
    return whole.union(more).union(found.select("row_id", "start", "end"))


def _spans(cover: DataFrame) -> DataFrame:
    """row_id and its stretches, merged where they meet, in order."""

    def merge(batches):
        for batch in batches:
            out = []
            for row, stretches in zip(batch.column("row_id").to_pylist(), batch.column("all").to_pylist()):
                spans: list[list[int]] = []
                for c in sorted(stretches, key=lambda c: c["start"]):
                    if spans and c["start"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], c["end"])
                    else:
                        spans.append([c["start"], c["end"]])
                out.append((row, [a for a, _ in spans], [b for _, b in spans]))
            yield _records(out, ["row_id", "starts", "ends"], [pa.int64()] + [pa.list_(pa.int64())] * 2)

    lists = cover.groupBy("row_id").agg(F.collect_list(F.struct("start", "end")).alias("all"))
    return lists.mapInArrow(merge, "row_id long, starts array<long>, ends array<long>")


def _remove(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What is left of each text without its stretches."""
    rows = []
    for doc_id, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "starts", "ends"))):
        data, spans = (text or "").encode("utf-8"), list(zip(starts or [], ends or []))
        kept, at = hashlib.sha256(), 0
        for a, b in spans:
            kept.update(data[at:a])
            at = b
        kept.update(data[at:])
        rows.append((doc_id, len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), ",".join(f"{a}:{b}" for a, b in spans)))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2
    return _records(rows, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"], kinds)


def _untouched(docs: DataFrame) -> DataFrame:
    """doc_id, doc_key, length and digest of every document as it is."""

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, keys = Texts(batch.column(1)), batch.column(2)
        whole = [texts.data[a:b] for a, b in zip(texts.offsets, texts.offsets[1:])]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), keys, pa.array([len(w) for w in whole], pa.int64()), pa.array([hashlib.sha256(w).hexdigest() for w in whole], pa.string())],
            names=["doc_id", "doc_key", "n_bytes", "kept_sha256"],
        )

    return map_slices(docs, compute, "doc_id long, doc_key long, n_bytes long, kept_sha256 string")


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans of every document.

    Texts without a repeated anchor are never shuffled while the others are at most BROADCAST_ROWS.
    """
    docs = doc_columns(docs).withColumn("doc_key", F.xxhash64("doc_id", "text"))
    places = saved(repeated_anchors(docs), "places")
    keys = places.select("doc_key")
    few = keys.count() <= BROADCAST_ROWS
    live = docs.join(F.broadcast(keys) if few else keys, "doc_key", "left_semi").join(places, "doc_key")
    live = live.select("doc_id", "text", "places").withColumn("row_id", F.monotonically_increasing_id())
    live = saved(live, "live")
    spans = saved(_spans(_cover(live)), "spans")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string"
    left = _beside(live.select("row_id", "doc_id", "text"), spans, "starts", "left").drop("row_id")
    rest = _untouched(docs).join(keys, "doc_key", "left_anti")
    none = F.lit(0).cast("long")
    rest = rest.select("doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), "kept_sha256", F.lit("").alias("spans"))
    return map_slices(left, _remove, out).union(rest)
