"""Periodic runs of words: stretches that repeat a block of words at least twice.

Internal pattern matching inside each text. Blocks of 4, 8, 16, ... words at every
half block ask where they occur again in the windows after them. A block is an
interval of the suffix array, and a wavelet tree over that array gives the
occurrences inside a window as range successors. In a window no wider than the
block they form an arithmetic progression, whose members are candidate periods;
each is extended to both sides by longest common extensions and kept if the
stretch is long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.words import CHUNK, Words, mix, ranges, window_hashes, within_text, word_chunks

# Words of the shortest run, and the fewest for which the smallest blocks suffice.
LEAST = 12
FEWEST = 9
# Words of the smallest blocks.
BLOCK = 4
# Candidate periods extended at once.
AT_ONCE = 1 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
ADDED = ("n_words", "runs", "collapsed_text")


class Suffixes:
    """Suffixes of texts at the words where a block of ``BLOCK`` words recurs in its text.

    ``place`` holds those words in text order; everything else speaks of them by
    number. ``order`` is the suffix array. ``ranks[k]`` names, for blocks of
    ``BLOCK << k`` words, the first place in ``order`` of the equal blocks, and
    ``sizes[k]`` says how many there are. A block that occurs once has the same
    rank on all further levels, and none that another block shares.
    """

    def __init__(self, symbol: np.ndarray, begin: np.ndarray):
        grams = window_hashes(symbol, BLOCK)[begin]
        order = np.argsort(grams, kind="stable")
        heads = _heads(grams[order])
        size = np.diff(np.append(heads, len(order)))
        place = np.sort(begin[order[np.repeat(size > 1, size)]])
        count = len(place)
        self.symbol, self.place = symbol, place
        self.number = np.full(len(symbol) + 1, -1, dtype=np.int32)
        self.number[place] = np.arange(count, dtype=np.int32)
        self.ranks: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        grams = window_hashes(symbol, BLOCK)[place]
        self.order = np.argsort(grams, kind="stable").astype(np.int32)
        rank, size = np.empty(count, dtype=np.int32), np.empty(count, dtype=np.int32)
        todo, slots, key = self.order, np.arange(count, dtype=np.int32), grams[self.order]
        width = BLOCK
        while len(todo):
            heads = _heads(key)
            sizes = np.diff(np.append(heads, len(todo)))
            rank[todo] = slots[np.repeat(heads, sizes)]
            size[todo] = np.repeat(sizes, sizes)
            shared = np.repeat(sizes > 1, sizes)
            if not shared.any():
                break
            self.ranks.append(rank.copy())
            self.sizes.append(size.copy())
            todo, slots = todo[shared], slots[shared]
            # Ordered by the block and then by the one behind it; a block behind
            # that does not recur tells its suffix from all others.
            behind = self.number[np.minimum(place[todo] + width, len(symbol))]
            second = np.where(behind >= 0, rank[behind], count + todo)
            key = rank[todo].astype(np.int64) * (2 * count + 1) + second
            by_key = np.argsort(key, kind="stable")
            todo, key = todo[by_key], key[by_key]
            self.order[slots] = todo
            width *= 2

    def _equal(self, level: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        a, b = self.number[one], self.number[other]
        known = (a >= 0) & (b >= 0)
        rank = self.ranks[level]
        return known & (rank[np.where(known, a, 0)] == rank[np.where(known, b, 0)])

    def forwards(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Words from ``one`` on that equal those from the later ``other`` on."""
        end, length = len(self.symbol), np.zeros(len(one), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            a, b = np.minimum(one + length, end), np.minimum(other + length, end)
            length += self._equal(level, a, b) * (BLOCK << level)
        for _ in range(BLOCK - 1):
            a, b = one + length, other + length
            inside = b < end
            length += inside & (self.symbol[np.where(inside, a, 0)] == self.symbol[np.where(inside, b, -1)])
        return length

    def backwards(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Words before ``one`` that equal those before the later ``other``."""
        length = np.zeros(len(one), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            width = BLOCK << level
            a, b = one - length - width, other - length - width
            inside = a >= 0
            length += (inside & self._equal(level, np.where(inside, a, 0), np.where(inside, b, 0))) * width
        for _ in range(BLOCK - 1):
            a, b = one - length - 1, other - length - 1
            inside = a >= 0
            length += inside & (self.symbol[np.where(inside, a, 0)] == self.symbol[np.where(inside, b, -1)])
        return length


def _heads(key: np.ndarray) -> np.ndarray:
    """Where a new value starts in sorted values."""
    if not len(key):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))


class Wavelet:
    """Wavelet tree, level by level, of a permutation of 0, 1, ...

    Holds for each level how many zero bits come before each place.
    """

    def __init__(self, values: np.ndarray):
        self.bits = max(int(len(values) - 1).bit_length(), 1)
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the values at ``low .. high - 1`` are smaller than ``value``."""
        low, high = low.astype(np.int64), high.astype(np.int64)
        every = high - low
        found = np.zeros(len(low), dtype=np.int64)
        for level, before in enumerate(self.zeros):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            a, z = before[low], before[high]
            found += np.where(one, z - a, 0)
            low = np.where(one, before[-1] + low - a, a)
            high = np.where(one, before[-1] + high - z, z)
        return np.where(value >> self.bits > 0, every, found)

    def nth(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value at ``low .. high - 1`` with ``nth`` smaller ones there."""
        low, high, nth = low.astype(np.int64), high.astype(np.int64), nth.copy()
        value = np.zeros(len(low), dtype=np.int64)
        for before in self.zeros:
            a, z = before[low], before[high]
            one = nth >= z - a
            nth -= np.where(one, z - a, 0)
            value = value * 2 + one
            low = np.where(one, before[-1] + low - a, a)
            high = np.where(one, before[-1] + high - z, z)
        return value


def _candidates(suffixes: Suffixes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``words, periods``: two places that a run of that period may join.

    A run with period p of 1.5 blocks less a word at least, and no more than 3
    blocks less two, has in it a block that starts at a half block, and the block
    p words on. Shorter periods are seen with the smallest blocks, as long as a
    run has ``FEWEST`` words.
    """
    place, tree = suffixes.place, Wavelet(suffixes.order.astype(np.int64))
    for level, (rank, size) in enumerate(zip(suffixes.ranks, suffixes.sizes)):
        width = BLOCK << level
        most = 3 * width - 2
        least = most // 2 if level else 1
        block = np.flatnonzero((size > 1) & (place % (width // 2) == 0))
        low, high = rank[block], rank[block] + size[block]
        word = place[block]
        since = tree.below(low, high, block + 1)  # the block itself is one of them
        for first in range(1, most + 1, width):
            if first + width - 1 < least and level:
                edge = np.searchsorted(place, word + first + width)
                since = tree.below(low, high, edge)
                continue
            edge = np.searchsorted(place, np.minimum(word + first + width, word + most + 1))
            until = tree.below(low, high, edge)
            hit = np.flatnonzero(until > since)
            if len(hit):
                yield from _progressions(
                    suffixes, tree, word[hit], low[hit], high[hit], since[hit], until[hit], least
                )
            since = until


def _progressions(suffixes, tree, word, low, high, since, until, least) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Periods from the occurrences ``since .. until - 1`` of each block."""
    place = suffixes.place
    count = until - since
    first = place[tree.nth(low, high, since)] - word
    step = np.zeros(len(word), dtype=np.int64)
    more = np.flatnonzero(count > 1)
    step[more] = place[tree.nth(low[more], high[more], since[more] + 1)] - word[more] - first[more]
    # Three or more occurrences: the block has the step as its period. In one
    # stretch of that period with the block they are no news but for the step.
    many = np.flatnonzero(count > 2)
    if len(many):
        a, b = word[many], word[many] + first[many]
        reach = a + step[many] + suffixes.forwards(a, a + step[many])
        joined = many[reach >= b + step[many]]
        single = joined[step[joined] >= least]
        yield word[single], step[single]
        keep = np.ones(len(word), dtype=bool)
        keep[joined] = False
        word, first, step, count = word[keep], first[keep], step[keep], count[keep]
    ends = np.cumsum(count)
    a = 0
    while a < len(word):
        z = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + AT_ONCE, side="right")), a + 1)
        number = ranges(np.zeros(z - a, dtype=np.int64), count[a:z])
        yield np.repeat(word[a:z], count[a:z]), np.repeat(first[a:z], count[a:z]) + number * np.repeat(step[a:z], count[a:z])
        a = z


def runs_of(words: Words, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of the runs in consecutive texts, in order of start, then period.

    Starts count the words of all texts. No run goes from one text into the next.
    """
    owner = np.repeat(np.arange(len(words.first) - 1, dtype=np.uint64), words.counts())
    symbol = mix(words.hash + mix(owner + np.uint64(1)))
    suffixes = Suffixes(symbol, within_text(words.first, BLOCK))
    found = [np.zeros((0, 3), dtype=np.int64)]
    if len(suffixes.place):
        for word, period in _candidates(suffixes):
            left = suffixes.backwards(word, word + period)
            length = left + period + suffixes.forwards(word, word + period)
            good = length >= np.maximum(least, 2 * period)
            rows = np.stack([word[good] - left[good], length[good], period[good]], axis=1)
            found.append(np.unique(rows, axis=0))
    rows = np.concatenate(found)
    # Multiples of a period give the same stretch; the smallest is its period.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):
        rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])]
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2]


def _kept_texts(data: np.ndarray, words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts made of the kept words, a space between two."""
    owner = np.repeat(np.arange(len(words.first) - 1), words.counts())[kept]
    count = np.bincount(owner, minlength=len(words.first) - 1)
    until = np.concatenate([[0], np.cumsum(count)])
    spaced = np.ones(len(owner), dtype=np.int64)
    spaced[until[1:][count > 0] - 1] = 0
    size = (words.end - words.start)[kept] + spaced
    offsets = np.concatenate([[0], np.cumsum(size)])
    text = np.append(data, np.uint8(32))[ranges(words.start[kept], size)]
    text[offsets[1:][spaced == 1] - 1] = 32
    return text, offsets[until]


def find_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed_text`` added.

    A run is a stretch of consecutive words of one text whose smallest period q
    goes into it twice at least, with ``least`` words or more, that no neighbouring
    word extends. ``runs`` lists ``start`` (number of its first word, from 0),
    ``length`` and ``period``, by start, then period. ``collapsed_text`` joins by
    one space the words that no run holds behind its first q words.

    NULL and empty texts have no words, no runs and an empty collapsed text;
    repeated rows are judged each by itself. An input column named like an added
    one is replaced. No rows give no rows. Words are equal when their 64-bit
    hashes are. No shuffle: a text is worked off whole in the task that reads it,
    with some 100 bytes for each word of a repeated block.
    """
    if least < FEWEST:
        raise ValueError(f"runs of fewer than {FEWEST} words are not looked for")
    bound_batches(docs.sparkSession)
    kept_names = [c for c in docs.columns if c not in ADDED]
    given = docs.select(*kept_names)
    position = kept_names.index(text_col)
    schema = given.withColumns(
        {"n_words": F.lit(0).cast("bigint"), "runs": F.lit(None).cast(RUNS), "collapsed_text": F.lit("")}
    ).schema

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, _, words in word_chunks(batch.column(position), False, CHUNK):
                start, length, period = runs_of(words, least)
                owner = np.searchsorted(words.first, start, side="right") - 1
                edge = np.zeros(len(words.start) + 1, dtype=np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, start + length, -1)
                kept, offsets = _kept_texts(data, words, np.cumsum(edge[:-1]) == 0)
                per_text = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=end - first))])
                runs = pa.ListArray.from_arrays(
                    pa.array(per_text, pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(start - words.first[owner]), pa.array(length), pa.array(period)],
                        ["start", "length", "period"],
                    ),
                )
                texts = pa.LargeStringArray.from_buffers(
                    end - first, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept)
                ).cast(pa.string())
                own = [c.slice(first, end - first) for c in batch.columns[: len(kept_names)]]
                arrays = [*own, pa.array(words.counts()), runs, texts]
                yield pa.RecordBatch.from_arrays(arrays, [*kept_names, *ADDED])

    return given.mapInArrow(search, schema)
