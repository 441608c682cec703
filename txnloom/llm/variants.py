"""Spelling variants: words one edit apart, found by pivotal grams, and the form each goes back to.

Bigrams are ordered from rare to frequent over all words. A word's prefix is its three rarest bigrams;
a single edit spoils at most two bigrams that overlap, so of the two disjoint ones that dynamic
programming picks from the prefix at least one, the pivot that survives, is also a bigram of any word one
edit away. Of two such words the one whose prefix ends earlier in the order finds its surviving pivot in
the prefix of the other. An edit makes at most two bigrams, so where the last bigram of the prefix repeats
in the word, two more of it are indexed.

An edit lies to one side of the surviving pivot. So the other side, the pivot included, is shared, at the
same place from that end, and on the edited side all but a block of code points around the edit, BLOCK of them
or an eighth of a long word.
Index and search go by all of this at once, which holds back the work on bigrams that many words have:
a gram and its place alone would meet a share of all words squared. Nothing is lost by it; candidates
are verified by edit distance.

Words are counted in each task before they are shuffled, and a pair of words meets by a hash of what it
shares, never within a group of all words. Null texts have no words, long texts are read whole, a null
id is written as no characters, repeated rows count as often as they come, ties of the largest count go
to the word that is least by code points, and empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Words have at least this many code points and occurrences.
SHORTEST, LEAST_COUNT = 7, 2
#: A form occurs this many times as often as its variant.
RATIO = 10
#: One run in so many loses a code point.
SLIP = 31
#: Code points around an edit that the search leaves open.
BLOCK = 4
#: Different words a task counts before it passes them on.
HELD = 1 << 18
#: Characters of keyed words that a task passes on at once, about.
HELD_BYTES = 1 << 23

RUNS = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)


def words_of(text: str, doc_id: int | None) -> Iterator[str]:
    """The words of a text, some with a slip of the pen that depends on document and word."""
    start = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
    # shorter runs cannot become longer
    runs = Counter(run.encode().lower() for run in RUNS.findall(text))
    for run, times in runs.items():
        h = zlib.crc32(run, start)
        word = run.decode()
        if h % SLIP == 0:
            gone = h % len(word)
            word = word[:gone] + word[gone + 1 :]
        if len(word) >= SHORTEST:
            yield word, times


def word_counts(docs: DataFrame, at_least: int = LEAST_COUNT) -> DataFrame:
    """word and n, its occurrences over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, times in words_of(text.as_py() or "", doc_id):
                    held[word] += times
                if len(held) >= HELD:
                    yield rows()
        yield rows()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= at_least)


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Place in the order and frequency of each bigram. The alphabet bounds their number, to 8,100."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    counts = grams.groupBy("gram").count().collect()
    ranked = sorted((count, gram) for gram, count in counts)
    return {gram: (rank, count) for rank, (count, gram) in enumerate(ranked)}


def prefix_grams(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[int], list[int], int]:
    """Places of the word's three rarest bigrams, those to index it by, and the rank of the last."""
    ranked = heapq.nsmallest(5, ((order[word[i : i + 2]][0], i) for i in range(len(word) - 1)))
    last = ranked[2][0]
    return sorted(i for _, i in ranked[:3]), sorted(i for rank, i in ranked if rank <= last), last


def pivots(word: str, places: list[int], order: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """The two disjoint bigrams among ``places``, ascending, that are rarest together."""
    best, chosen = math.inf, None
    least, first, behind = math.inf, None, 0
    for place in places:
        # the rarest single bigram that ends before this one
        while places[behind] <= place - 2:
            weight = order[word[places[behind] : places[behind] + 2]][1]
            if weight < least:
                least, first = weight, places[behind]
            behind += 1
        weight = least + order[word[place : place + 2]][1]
        if weight < best:
            best, chosen = weight, (first, place)
    return chosen


def block_size(length: int) -> int:
    return max(BLOCK, -(-length // 8))


def _part(text: str) -> str:
    """What stands for a part of a word in a key: itself, or a digest if it is long."""
    return text if len(text) <= 64 else blake2b(text.encode(), digest_size=16).hexdigest()


def _right(word: str, pivot: int, low: int, high: int, change: int) -> Iterator[str]:
    """Keys for an edit at ``low`` to ``high``, right of the pivot; the other word is ``change`` longer."""
    size = block_size(len(word) + change)
    for block in range(low // size, high // size + 1):
        head = max(block * size, pivot + 2)
        yield f"R{pivot} {block} {_part(word[:head])} {_part(word[(block + 1) * size - change :])}"


def _left(word: str, pivot: int, low: int, high: int, change: int) -> Iterator[str]:
    """Keys for an edit at ``low`` to ``high``, left of the pivot."""
    size = block_size(len(word) + change)
    for block in range(low // size, high // size + 1):
        tail = min((block + 1) * size - change, pivot)
        yield f"L{len(word) - pivot} {block} {_part(word[: block * size])} {_part(word[tail:])}"


def index_keys(word: str, places: list[int]) -> set[str]:
    """What a word is found by: each bigram of its prefix, with an edit on either side."""
    keys: set[str] = set()
    for place in places:
        keys.update(_right(word, place, place + 2, len(word), 0))
        keys.update(_left(word, place, 0, place, 0))
    return keys


def search_keys(word: str, pair: tuple[int, int]) -> set[str]:
    """What a word looks for: whatever is edited, a pivot beside it survives."""
    a, b = pair
    keys: set[str] = set()
    for change in (-1, 0, 1):
        keys.update(_right(word, b, b + 2, len(word), change))
        keys.update(_right(word, a, a + 2, b + 1, change))
        keys.update(_left(word, b, a, a + 1, change))
        if a:
            keys.update(_left(word, a, 0, a - 1, change))
    return keys


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: each pair of words one edit apart, once either way."""
    order = gram_order(words)

    def keyed(search: bool):
        def keys_of(word: str) -> tuple[set[str], int]:
            rarest, indexed, last = prefix_grams(word, order)
            return search_keys(word, pivots(word, rarest, order)) if search else index_keys(word, indexed), last

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, rows, lasts, size = [], [], [], 0

                def out() -> pa.RecordBatch:
                    at = pa.array(rows, pa.int32())
                    columns = [pa.array(keys, pa.string()), *(c.take(at) for c in batch.columns), pa.array(lasts, pa.int32())]
                    return pa.RecordBatch.from_arrays(columns, names=["key", "word", "n", "last"])

                for row, word in enumerate(batch.column(0).to_pylist()):
                    found, last = keys_of(word)
                    keys.extend(found)
                    rows.extend([row] * len(found))
                    lasts.extend([last] * len(found))
                    size += len(found) * len(word)
                    if size > HELD_BYTES:
                        yield out()
                        keys, rows, lasts, size = [], [], [], 0
                yield out()

        out = words.select("word", "n").mapInArrow(run, "key string, word string, n long, last int")
        return out.withColumn("key", F.xxhash64("key"))

    searched = keyed(True).toDF("key", "word", "n", "last")
    indexed = keyed(False).toDF("key", "near", "near_n", "near_last")
    met = searched.join(indexed, "key").where("last <= near_last and abs(length(word) - length(near)) <= 1")
    close = met.where(F.levenshtein("word", "near", 1) == 1)
    one, two = F.struct("word", "n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"))
    pairs = close.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    both = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))
    each = pairs.select(F.explode(both).alias("pair"))
    return each.select("pair.x.word", "pair.x.n", F.col("pair.y.word").alias("near"), F.col("pair.y.n").alias("near_n"))


def word_forms(words: DataFrame) -> DataFrame:
    """Each word with n, form, form_n, n_near: the near word of largest n, where that is RATIO times as much."""
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(near, "word", "left")
    much = -F.col("best.rank") >= RATIO * F.col("n")
    return rows.select(
        "word",
        "n",
        F.when(much, F.col("best.near")).alias("form"),
        F.when(much, -F.col("best.rank")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` with ``root``, where following forms ends.

    Each step multiplies n by RATIO at least, so the most frequent word bounds the steps; each round
    doubles those taken.
    """
    forms = saved(forms, "forms")
    most = forms.agg(F.max("form_n")).first()[0] or 0
    steps = max(0, math.ceil(math.log(max(most, 1) / LEAST_COUNT, RATIO))) if most else 0
    links = forms.where("form is not null").select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(onward, "root", "left")
        links = saved(links.select("word", F.coalesce("further", "root").alias("root")), "roots")
        reach *= 2
    return forms.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variant_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row for each word of ``docs``."""
    words = saved(word_counts(docs), "words")
    return with_roots(word_forms(words)).select("word", "form", "root", "n", "n_near", "form_n")
