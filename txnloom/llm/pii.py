"""Personal data: four fixed kinds, and identifiers that share their contexts.

The fixed kinds (email, ip, card, phone) and strings shaped like keys (32 or more hexadecimal digits,
letters among them) seed a graph of instances and lexical patterns. A pattern is what stands beside an
instance: the word before, the two words before, the word after, or the words on both sides, whole words
however long, in lower case by A-Z. In each round a pattern is worth the sum of its instances' worth over
all places where it occurs, whatever stands there, and ``PRIOR`` worthless ones; a seed is worth one, and
an unseen instance, a word of at least ``MIN_LENGTH`` characters with a digit, as much as its best
pattern. Patterns of fewer than ``SUPPORT`` different instances count nothing, nor those that could not be
worth ``ACCEPT`` if all their instances were worth one. After the rounds every word
with a digit beside a pattern worth ``ACCEPT``, fixed kinds aside, is reported as kind ``id``, without
the marks around it. Identifiers without a digit are never reported.

The graph has a row for each identifier found, never for ordinary words: where a pattern occurs is
counted on the texts for the patterns that the graph needs, ``BLOCK`` of them in one pass. A null text is
empty and has no spans; a long text takes time in proportion, whatever its words. Rows of one id, equal
ones too, are judged each for itself; instances of equal worth need no order. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, saved, slices
from .tokens import LOWER, U64, Texts, mix, run_hashes

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
ROUNDS, PRIOR, ACCEPT, MIN_LENGTH, SUPPORT = 3, 2.0, 0.5, 6, 3
#: Patterns whose places are counted in one pass over the texts, 32 MB of hashes; one in so many texts is
#: looked at first, to leave out patterns that ordinary words have too often. That decides cost only.
BLOCK, PART = 4_000_000, 16

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
# a match can't begin within a run of digits: it would already have begun at the run's first
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
KEY_SHAPE = re.compile(r"(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{32,}")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = ".,;:!?\"'()[]{}<>#$%&*|"

Span = tuple[int, int, str]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ is tried once: its local part is the run before it, so long runs cost no retries."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1, start):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The fixed kinds, by start and then in their order."""
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            # at most 255 as a number, however many zeros it is written with
            if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m.group().split(".")):
                found.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m.group())) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def key(kind: str, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}:{text}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def patterns(words: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The patterns of stretches of words, a row for each stretch and a column for each kind.

    ``words`` are hashes of all words and ``text`` the text of each; a stretch goes from word ``low`` to
    word ``high``. Beyond the ends of its text stand words of hash 0.
    """

    def word(at: np.ndarray) -> np.ndarray:
        there = (at >= 0) & (at < len(words))
        there[there] = text[at[there]] == text[low[there]]
        out = np.zeros(len(at), np.uint64)
        out[there] = words[at[there]]
        return out

    one, two, after = word(low - 1), word(low - 2), word(high + 1)
    kinds = (one, mix(two + U64(1)) + one, after, mix(one + U64(2)) + after)
    return np.stack([mix(kind + U64(3 + i)) for i, kind in enumerate(kinds)], axis=1)


def tokens(text: str, base: list[Span]) -> list[tuple[int, int, bool]]:
    """(start, end, key-shaped) of the words with a digit, without marks around them, outside ``base``."""
    out = []
    if DIGIT.search(text):
        taken = sorted((a, b) for a, b, _ in base)
        starts = [a for a, _ in taken]
        ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.empty(0)
        for m in WORD.finditer(text):
            if not DIGIT.search(m.group()):
                continue
            a, b = m.span()
            while a < b and text[a] in EDGE:
                a += 1
            while b > a and text[b - 1] in EDGE:
                b -= 1
            i = int(np.searchsorted(starts, b))
            if b - a >= MIN_LENGTH and not (i and ends[i - 1] > a):
                out.append((a, b, KEY_SHAPE.fullmatch(text, a, b) is not None))
    return out


def _hashed(column: pa.Array) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray]:
    """The texts, the first byte and the hash of each word, and the text that has it."""
    texts = Texts(column)
    start, end = texts.words()
    return texts, start, run_hashes(LOWER[texts.data], start, end), texts.doc_of(start)


def candidates(column: pa.Array) -> list[tuple[list[Span], list[dict]]]:
    """Of each text the base spans, and all instances with their places, patterns and whether they seed."""
    texts, start, words, doc = _hashed(column)
    found, lows, highs = [], [], []
    for row, text in enumerate(column.to_pylist()):
        text = text or ""
        base = base_spans(text)
        each = [(a, b, key(kind, text[a:b]), True, False) for a, b, kind in base]
        each += [(a, b, key(FOUND, text[a:b]), shaped, True) for a, b, shaped in tokens(text, base)]
        found.append((base, each))
        # bytes before a code point, from one stretch of text to the next
        points = sorted({p for a, b, *_ in each for p in (a, b - 1)})
        bytes_at, done, total = {}, 0, int(texts.offsets[row])
        for p in points:
            total += len(text[done:p].encode())
            done = p
            bytes_at[p] = total
        for a, b, *_ in each:
            lows.append(bytes_at[a])
            highs.append(bytes_at[b - 1])
    low, high = (np.searchsorted(start, np.array(side, np.int64), side="right") - 1 for side in (lows, highs))
    beside = iter(patterns(words, doc, low, high).view(np.int64).tolist() if len(low) else ())
    names = ("start", "end", "instance", "seed", "open")
    return [(base, [dict(zip(names, c), patterns=next(beside)) for c in each]) for base, each in found]


def extract(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, base (spans as text, in order) and the candidates of every document."""
    item = pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("seed", pa.bool_()), ("open", pa.bool_()),
         ("patterns", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch):
                each = candidates(part.column(1))
                n = len(each)
                base = [[f"{kind}:{a}:{b}" for a, b, kind in spans] for spans, _ in each]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), part.column(0), pa.array(base, pa.list_(pa.string())),
                     pa.array([rows for _, rows in each], pa.list_(item))],
                    names=["row_id", "doc_id", "base", "found"],
                )
                row += n

    schema = (
        "row_id long, doc_id long, base array<string>, found array<struct<start: long, end: long,"
        " instance: long, seed: boolean, open: boolean, patterns: array<bigint>>>"
    )
    return doc_columns(docs).mapInArrow(run, schema)


def places(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """pattern and total, the words of all texts that stand where a pattern of ``wanted`` says.

    ``wanted`` is a stored table of patterns. They are told to the tasks in blocks, so the number of
    passes grows with the patterns and what a task holds does not.
    """
    wanted = saved(wanted.withColumn("place", F.monotonically_increasing_id()), "wanted-patterns")
    blocks = -(-wanted.count() // BLOCK)
    counts = None
    for block in range(blocks):
        here = wanted.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block).select("pattern").toArrow()
        known = np.sort(here["pattern"].to_numpy())

        def count(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            hits = np.zeros(len(known), np.int64)
            for batch in batches:
                for part in slices(batch):
                    _, _, words, doc = _hashed(part.column(0))
                    if len(words) and len(known):
                        every = np.arange(len(words))
                        seen = patterns(words, doc, every, every).view(np.int64).ravel()
                        at = np.minimum(np.searchsorted(known, seen), len(known) - 1)
                        hits += np.bincount(at[known[at] == seen], minlength=len(known))
            some = np.flatnonzero(hits)
            yield pa.RecordBatch.from_arrays([pa.array(known[some]), pa.array(hits[some])], names=["pattern", "total"])

        found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "pattern long, total long")
        found = found.groupBy("pattern").agg(F.sum("total").alias("total"))
        counts = found if counts is None else counts.union(found)
    return counts if counts is not None else wanted.select("pattern", F.lit(0).cast("long").alias("total"))


def _worthy(sizes: DataFrame, totals: DataFrame, accept: float) -> DataFrame:
    """pattern, n and total, where instances could make the pattern worth ``accept``, were all of worth one."""
    rows = sizes.join(totals, "pattern", "left").fillna(0, ["total"])
    return rows.where(F.col("n") >= accept * (F.col("total") + PRIOR))


def score_patterns(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern and worth, from edges (pattern, instance, seed, n) and the places of each pattern."""
    edges = edges.join(totals.select("pattern"), "pattern")
    seeds = edges.where("seed").groupBy("pattern").agg(F.sum("n").alias("known"))
    unseen = saved(edges.where("not seed").select("pattern", "instance", "n"), "unseen")
    size = saved(totals.join(seeds, "pattern", "left").fillna(0, ["known"]), "pattern-size")
    worth = size.select("pattern", (F.col("known") / (F.col("total") + PRIOR)).alias("worth"))
    for _ in range(rounds - 1):
        linked = unseen.join(worth, "pattern")
        instance = linked.groupBy("instance").agg(F.max("worth").alias("worth"))
        more = unseen.join(instance, "instance").groupBy("pattern").agg(F.sum(F.col("worth") * F.col("n")).alias("more"))
        total = F.col("known") + F.coalesce("more", F.lit(0.0))
        worth = size.join(more, "pattern", "left").select("pattern", (total / (F.col("total") + PRIOR)).alias("worth"))
        worth = saved(worth, "pattern-worth")
    return worth


def personal_data(docs: DataFrame, rounds: int = ROUNDS, accept: float = ACCEPT) -> DataFrame:
    """A row for each document: counts of the fixed kinds, their digest, and all spans."""
    rows = saved(extract(docs), "pii")
    each = rows.select("row_id", F.explode("found").alias("c")).select("row_id", "c.*")
    sides = F.explode("patterns").alias("pattern")
    edges = each.select(sides, "instance", "seed").groupBy("pattern", "instance", "seed").agg(F.count("*").alias("n"))
    edges = saved(edges, "pii-edges")
    # patterns that enough different instances share; the others need not be counted on the texts
    wide = edges.groupBy("pattern").agg(F.count("*").alias("k"), F.sum("n").alias("n")).where(F.col("k") >= SUPPORT)
    wide = saved(wide.drop("k"), "pattern-sizes")
    # of most patterns a part of the texts already has too many places; the rest are counted on all texts
    some = docs.where(F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(PART)) == 0)
    possible = _worthy(wide, places(some, wide.select("pattern")), accept).drop("total")
    possible = saved(possible, "possible-patterns")
    totals = saved(_worthy(possible, places(docs, possible.select("pattern")), accept).drop("n"), "pattern-places")
    good = score_patterns(edges, totals, rounds).where(F.col("worth") >= accept).select("pattern")
    unseen = each.where("open").select("row_id", "start", "end", sides)
    found = unseen.join(good, "pattern").select("row_id", "start", "end").distinct()
    found = found.groupBy("row_id").agg(F.collect_list(F.struct("start", "end")).alias("more"))
    joined = rows.drop("found").join(found, "row_id", "left")
    count = lambda kind: F.size(F.filter("base", lambda s: s.startswith(f"{kind}:"))).cast("long")

    # kind:start:end, to be ordered by start and then by kind
    order = {kind: i for i, kind in enumerate((*KINDS, FOUND))}
    ranks = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    parts = lambda s: F.split(s, ":")
    own = F.transform("base", lambda s: F.struct(parts(s)[1].cast("long"), ranks[parts(s)[0]], s))
    other = F.transform(
        F.coalesce("more", F.array().cast("array<struct<start: long, end: long>>")),
        lambda c: F.struct(c["start"], F.lit(order[FOUND]), F.concat_ws(":", F.lit(FOUND), c["start"], c["end"])),
    )
    kind = "array<struct<start: long, rank: int, span: string>>"
    spans = F.array_sort(F.concat(own.cast(kind), other.cast(kind)))
    return joined.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, lambda s: s["span"]), ",").alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_found"),
        (F.size("base") + F.coalesce(F.size("more"), F.lit(0))).cast("long").alias("n_spans"),
    )
