"""Hashes of all words of many texts at once, on the UTF-8 bytes that Arrow holds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_CODES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)

#: Byte tables: A-Z to a-z, and what separates words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Every ASCII character but letters and digits.
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = [not chr(i).isalnum() for i in range(128)]

_powers = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 18), base, dtype=U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit integers (multiply and shift)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column; null reads as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), offsets


def runs(offsets: np.ndarray, max_bytes: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Bounds of runs of whole texts with about max_bytes bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


@dataclass
class Words:
    """The words of a run of texts, in order."""

    hashes: np.ndarray  # one 64-bit hash a word
    doc: np.ndarray  # number of its text within the run
    start: np.ndarray  # first byte within the run
    end: np.ndarray  # byte after the last
    first: np.ndarray  # by text: its first word; one more entry than texts


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> Words:
    """Words are the maximal runs of bytes outside separators within a text; A-Z count as a-z."""
    n_docs, begin = len(offsets) - 1, int(offsets[0])
    low = LOWER[data[begin : int(offsets[-1])]]
    offsets = offsets - begin
    n = len(low)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none.astype(U), none, none, none, np.zeros(n_docs + 1, np.int64))
    inside = ~separators[low]
    opens = np.zeros(n + 1, dtype=bool)
    opens[offsets[:-1]] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | opens[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    opens[n] = True
    end = np.flatnonzero(inside & (~after | opens[1:])) + 1
    power, inverse = _power_tables(n)
    sums = _CODES[low]
    sums *= power[:n]
    np.cumsum(sums, out=sums)
    hashes = sums[end - 1]
    later = start > 0
    hashes[later] -= sums[start[later] - 1]
    hashes *= inverse[start]
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(mix(hashes), doc, start, end, np.searchsorted(doc, np.arange(n_docs + 1)))
