"""Vectorised words, hashes and shingles over Arrow string columns.

A *word* is a maximal run of bytes outside ``\\x20\\x09-\\x0D``; UTF-8 continuation bytes are
never white space, so the byte view equals the character view.  All functions work on
slices of about a megabyte of text, so the temporary arrays of a task stay small whatever
the Arrow batch holds; one document is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SMALL_SLICE = 1 << 18  # where a worker's memory must stay low

_RNG = np.random.Generator(np.random.PCG64(20240611))
BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its values; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, bounds


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    raw, bounds = utf8(column)
    n, lo = len(bounds) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def spans_of(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that don't cross a document's bounds."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[bounds] = True
    before = np.ones(n, dtype=bool)
    before[1:] = ~inside[:-1]
    after = np.ones(n, dtype=bool)
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | cut[:n]))
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    return starts, ends


class SpanHash:
    """Hashes of byte spans from one pass of prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * _powers(BASE, n), out=self.sums[1:])
        self.inverse = _powers(INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(h ^ (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a slice: byte spans, the row each is in, hashes, and the words before each row."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # per row, plus the total


def words(data: np.ndarray, bounds: np.ndarray, lower: bool) -> Words:
    starts, ends = spans_of(~IS_SPACE[data], bounds)
    hashes = SpanHash(LOWER[data] if lower else data)(starts, ends)
    first = np.searchsorted(starts, bounds)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(starts, ends, row, hashes, first)


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and hash, of each run of ``k`` words inside one row."""
    n = len(w.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.row[:n] == w.row[k - 1 :])
    h = np.full(len(at), k, dtype=np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(BASE) + w.hashes[at + j])
    return at, h


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word runs; with fewer words the whole
    sequence is one shingle; without words the set is empty."""
    at, h = windows(w, k)
    edges = np.searchsorted(at, w.first)
    out = []
    for r in range(len(w.first) - 1):
        lo, hi = edges[r], edges[r + 1]
        if hi > lo:
            out.append(np.unique(h[lo:hi]))
            continue
        own = w.hashes[w.first[r] : w.first[r + 1]]
        if len(own):
            one = np.full(1, len(own), dtype=np.uint64)
            for x in own:
                one = mix(one * np.uint64(BASE) + x)
            out.append(one)
        else:
            out.append(own)
    return out


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
