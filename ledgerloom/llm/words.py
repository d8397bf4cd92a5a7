"""Words and their hashes, for whole Arrow batches at a time.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` in the UTF-8 text. Texts
are taken whole; a batch is worked off in chunks of whole texts, so the arrays
of one chunk, not of one batch, bound the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once; a longer text is a chunk of its own.
CHUNK = 1 << 19

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """Words of consecutive texts: where they lie and what they hash to."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text: index of its first word; one more at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (one more than texts) of a string column; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]
    return whole, ends - ends[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes, or of one longer text."""
    first, last = 0, len(offsets) - 1
    while first < last:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), last)
        yield first, end
        first = end


class Hasher:
    """Hashes of byte ranges by differences of one running sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers = np.full(n, BASE, dtype=np.uint64)
        back = np.full(n + 1, BASE_INVERSE, dtype=np.uint64)
        if n:
            powers[0] = 1
        back[0] = 1
        self.back = np.cumprod(back)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * np.cumprod(powers), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        summed = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(summed + (end - start).astype(np.uint64))


def hash_bytes(value: bytes) -> int:
    """The hash a word with these bytes gets."""
    data = np.frombuffer(value, dtype=np.uint8)
    return int(Hasher(data).of(np.array([0]), np.array([len(data)]))[0])


def split_words(data: np.ndarray, offsets: np.ndarray, hasher: Hasher | None = None) -> Words:
    """Words of texts laid end to end; ``offsets`` start at 0."""
    n = len(data)
    space = SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    at = offsets[:-1][offsets[:-1] < n]
    begins[at] = ~space[at]
    ends = ~space
    ends[:-1] &= space[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = ~space[last]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    hashes = (hasher or Hasher(data)).of(start, end)
    return Words(start, end, hashes, np.searchsorted(start, offsets))


def word_chunks(
    column: pa.Array, lower: bool, limit: int = CHUNK
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Words]]:
    """``first, end, bytes, offsets, words`` for chunks of a text column.

    ``bytes`` are as hashed: with ``lower``, A-Z are lower-cased.
    """
    data, offsets = text_bytes(column)
    for first, end in chunks(offsets, limit):
        part = data[offsets[first] : offsets[end]]
        if lower:
            part = LOWER[part]
        own = offsets[first : end + 1] - offsets[first]
        yield first, end, part, own, split_words(part, own)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words, by index of the first."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total += hashes[i : i + n] * np.uint64(pow(BASE, 2 * i + 1, 1 << 64) | 1)
    return mix(total)


def within_text(first: np.ndarray, width: int) -> np.ndarray:
    """Indices of the words at which a window of ``width`` words of one text starts."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    return ranges(first[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``counts[i]`` of them), one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)
