"""Cost-balanced packing of tokenised documents into sequences of fixed capacity.

Each task tokenises its rows and packs them in rounds of bounded size, so nothing is shuffled and
the work is as even as the partitions. Within a round every full capacity of a long document is a
sequence of its own; what remains of each document is taken by descending estimated cost (linear
plus quadratic in its length) and put into the sequence that costs least so far and has room. A
piece that fits nowhere whole is cut to fill the sequences with most room. The last part of a
round that fills no sequence is cut into powers of two, which need no padding.

Nulls and empty texts are the one end token. Repeated rows and repeated ids are packed each for
itself. Sequence ids are unique within one run; which ids a piece gets follows the partitions.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import doc_columns, slices

CAPACITY = 1024
END = 0
#: Tokens that one round packs together, about.
ROUND = 1 << 19
#: Cost of a piece of n tokens: n * (LINEAR + QUADRATIC * n), in units of one token's linear work.
LINEAR, QUADRATIC = 1.0, 1 / 2048
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def tokenizers_of(vocabulary: str, ranks: str):
    """Two readers of one vocabulary: the reference one, and a faster one for ordinary text."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return exact, fast


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(text: str | None, vocabulary: str, ranks: str) -> np.ndarray:
    """The ids of a text and the end token. The fast reader gives the same ids wherever the text
    names no special token; there the vocabulary's own reader is used."""
    exact, fast = tokenizers_of(vocabulary, ranks)
    if not text:
        ids = []
    elif SPECIAL in text:
        ids = exact.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary(text)
    out = np.empty(len(ids) + 1, "<u4")
    out[:-1], out[-1] = ids, END
    return out


def cost(n: int) -> float:
    return n * (LINEAR + QUADRATIC * n)


def assign(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one round, each token in exactly one.

    Open sequences wait in a heap by cost. A document that doesn't fit the cheapest ones is tried
    on the next, in order of cost.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    rest: list[tuple[int, int, int]] = []  # length, document, start
    for d, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            pieces.append((d, k * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, d, whole * capacity))
    rest.sort(key=lambda x: (-cost(x[0]), x[1]))
    total = sum(x[0] for x in rest)
    open_ = total // capacity
    first = sequence
    used = [0] * open_
    heap = [(0.0, s) for s in range(open_)]
    left: list[tuple[int, int, int]] = []
    for n, d, start in rest:
        passed = []
        while heap and used[heap[0][1]] + n > capacity:
            passed.append(heapq.heappop(heap))
        if heap:
            spent, s = heapq.heappop(heap)
            pieces.append((d, start, n, first + s, used[s]))
            used[s] += n
            if used[s] < capacity:
                heapq.heappush(heap, (spent + cost(n), s))
        else:
            left.append((n, d, start))
        for x in passed:
            heapq.heappush(heap, x)
    # what fits nowhere whole fills the room that is left, most room first
    room = sorted(((capacity - used[s], s) for _, s in heap if used[s] < capacity), reverse=True)
    k = 0
    tail: list[tuple[int, int, int]] = []
    for n, d, start in left:
        while n and k < len(room):
            free, s = room[k]
            take = min(n, free)
            pieces.append((d, start, take, first + s, used[s]))
            used[s] += take
            n, start = n - take, start + take
            room[k] = (free - take, s)
            k += free == take
        if n:
            tail.append((n, d, start))
    sequence = first + open_
    remaining = sum(x[0] for x in tail)
    size, offset = 0, 0
    for n, d, start in tail:
        while n:
            if not size:
                size, offset = 1 << (remaining.bit_length() - 1), 0
            take = min(n, size - offset)
            pieces.append((d, start, take, sequence, offset))
            n, start, offset, remaining = n - take, start + take, offset + take, remaining - take
            if offset == size:
                sequence, size = sequence + 1, 0
    return pieces


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    own = paths()
    vocabulary, ranks = vocabulary or own[0], ranks or own[1]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def flush(ids: list, tokens: list[np.ndarray], base: int) -> tuple[pa.RecordBatch, int]:
        pieces = assign([len(t) for t in tokens], capacity)
        columns = [
            pa.array([ids[p[0]] for p in pieces], pa.int64()),
            pa.array([p[1] for p in pieces], pa.int64()),
            pa.array([p[2] for p in pieces], pa.int64()),
            pa.array([zlib.crc32(tokens[p[0]][p[1] : p[1] + p[2]].tobytes()) for p in pieces], pa.int64()),
            pa.array([len(tokens[p[0]]) for p in pieces], pa.int64()),
            pa.array([base + p[3] for p in pieces], pa.int64()),
            pa.array([p[4] for p in pieces], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names), base + 1 + max(p[3] for p in pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        ids, tokens, held = [], [], 0
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(doc_id)
                    tokens.append(encode(text, vocabulary, ranks))
                    held += len(tokens[-1])
                    if held >= ROUND:
                        out, base = flush(ids, tokens, base)
                        yield out
                        ids, tokens, held = [], [], 0
        if ids:
            yield flush(ids, tokens, base)[0]

    schema = ", ".join(f"{name} long" for name in names)
    return doc_columns(docs).mapInArrow(run, schema)
