"""Words, lines and shingles of many texts at once, as numpy arrays of positions and hashes.

Everything works on the UTF-8 bytes of a slice of rows laid end to end. White space is one byte
each (space and 9 to 13), so words never cut a code point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_random = np.random.Generator(np.random.PCG64(20240917))
CODES = _random.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
STEP = U64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.full(1 << 12, STEP))

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORDLIKE = np.zeros(256, bool)
WORDLIKE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def powers(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * _powers[-1]])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all others."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Texts:
    """The bytes of some texts, end to end; a null text is empty."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, offsets, data = column.buffers()
        if len(column) == 0:
            self.offsets, self.data = np.zeros(1, np.int64), np.empty(0, np.uint8)
            return
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the maximal runs of flagged bytes; runs end with their text."""
        n = len(inside)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        filled = self.offsets[1:] > self.offsets[:-1]
        before[self.offsets[:-1][filled]] = False
        after[self.offsets[1:][filled] - 1] = False
        return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each line; lines are what lies between line feeds."""
        breaks = np.flatnonzero(self.data == 10)
        start = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]), kind="stable")
        end = np.sort(np.concatenate([self.offsets[1:], breaks]), kind="stable")
        counts = np.bincount(self.doc_of(breaks), minlength=len(self)) + 1
        return start, end, np.repeat(np.arange(len(self)), counts)


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes."""
    out = np.zeros(len(start), np.uint64)
    lengths = end - start
    some = lengths > 0
    if some.any():
        start, lengths = start[some], lengths[some]
        first = np.cumsum(lengths) - lengths
        position = np.arange(lengths.sum()) - np.repeat(first, lengths)
        codes = CODES[data[position + np.repeat(start, lengths)]] * powers(int(lengths.max()))[position]
        out[some] = np.add.reduceat(codes, first)
    return mix(out + U64(1))


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first position of each run of ``size`` items within one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * STEP + hashes[i : i + n]
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    return mix(total[at]), at


def with_doc(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts, to compare only within each."""
    return mix(hashes + mix(doc.astype(np.uint64) + U64(1)))


def distinct(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes of each text, ordered by text and hash."""
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], doc[new]
