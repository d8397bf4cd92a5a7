"""Spelling variants: words one inserted, deleted or replaced character apart, and their forms.

Two words one error apart agree on one half of the shorter one, at its own end of
the word. So words meet in groups by an exact half; the words of some groups make
a delimited vocabulary with a bidirectional FM-index. A search matches the exact
half outwards from its inner end to the delimiter, turns round, and extends across
the other half with one error: an interval of suffix ranks in either direction is
all it carries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.session import settle

# Letters of a vocabulary that is indexed at once, about. A group with more than
# GROUP words is split by the exact half of its inexact half.
LETTERS = 1 << 16
GROUP = 3000
# Ranks from one count of letters to the next.
STEP = 16

PARTIAL = "word string, n_near bigint, near_n bigint, near string"


def _order(codes: np.ndarray, letters: int) -> np.ndarray:
    """Suffix array of a circular text of codes below ``letters``, by prefix doubling."""
    count = len(codes)
    bits = max(int(letters - 1).bit_length(), 1)
    width = max(62 // bits, 1)
    key = np.zeros(count, dtype=np.int64)
    ring = np.concatenate([codes, codes[:width]]) if width <= count else np.tile(codes, width // count + 2)
    for i in range(width):
        key = (key << bits) | ring[i : i + count]
    while True:
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[False], key[order][1:] != key[order][:-1]])
        rank = np.empty(count, dtype=np.int64)
        rank[order] = np.cumsum(new)
        if width >= count or rank[order[-1]] == count - 1:
            return order
        key = rank * count + np.roll(rank, -(width % count))
        width *= 2


class Direction:
    """Ranks of one reading direction: how often each letter occurs ahead of each rank.

    Counted at every ``STEP`` ranks; the letters in between are looked at.
    """

    def __init__(self, codes: np.ndarray, letters: int):
        self.order = _order(codes, letters)
        blocks = len(codes) // STEP + 1
        padded = np.full(blocks * STEP, letters, dtype=np.int32)
        padded[: len(codes)] = codes[self.order - 1]
        self.blocks = padded.reshape(blocks, STEP)
        counts = np.zeros((blocks + 1, letters + 1), dtype=np.int32)
        for i in range(STEP):
            counts[np.arange(1, blocks + 1), self.blocks[:, i]] += 1
        self.counts = np.cumsum(counts, axis=0, dtype=np.int32)
        totals = self.counts[-1]
        self.first = (np.cumsum(totals) - totals).astype(np.int64)
        self.below = np.cumsum(self.counts, axis=1, dtype=np.int32) - self.counts

    def occurs(self, rank: np.ndarray, letter: np.ndarray) -> np.ndarray:
        block, rest = rank // STEP, rank % STEP
        seen = (self.blocks[block] == letter[:, None]) & (np.arange(STEP) < rest[:, None])
        return self.counts[block, letter] + seen.sum(axis=1)

    def smaller(self, rank: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Occurrences of smaller letters: how far the other direction's interval moves."""
        block, rest = rank // STEP, rank % STEP
        seen = (self.blocks[block] < letter[:, None]) & (np.arange(STEP) < rest[:, None])
        return self.below[block, letter] + seen.sum(axis=1)

    def every(self, rank: np.ndarray) -> np.ndarray:
        """``occurs`` of all letters, a row per rank."""
        block, rest = rank // STEP, rank % STEP
        rows = self.counts[block]
        for i in range(STEP - 1):
            ahead = np.flatnonzero(rest > i)
            rows[ahead, self.blocks[block[ahead], i]] += 1
        return rows


class Vocabulary:
    """Bidirectional FM-index of distinct words, each between delimiters (letter 0)."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("\0".join(["", *words, ""]).encode("utf-32-le"), dtype=np.uint32)
        known, codes = np.unique(points, return_inverse=True)
        self.codes, letters = codes.astype(np.int64), len(known)
        ends = np.flatnonzero(self.codes == 0)
        self.starts, self.lengths = ends[:-1] + 1, np.diff(ends) - 1
        # Reading leftwards prepends a letter, reading rightwards appends one.
        self.leftwards = Direction(self.codes, letters)
        self.rightwards = Direction(self.codes[::-1], letters)

    def letter(self, word: np.ndarray, place: np.ndarray, mirrored: bool) -> np.ndarray:
        """Letters of words read forwards or, mirrored, backwards; the delimiter ahead of and behind them."""
        at = self.lengths[word] - 1 - place if mirrored else place
        return self.codes[self.starts[word] + at]

    def same_ahead(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Letters that two words have in common from their starts."""
        same = np.zeros(len(one), dtype=np.int64)
        live = np.arange(len(one))
        while len(live):
            letter = self.letter(one[live], same[live], False)
            live = live[(letter > 0) & (letter == self.letter(other[live], same[live], False))]
            same[live] += 1
        return same

    def pairs(self, asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``asked`` and found words; the found one has as many letters, or one more.

        The first letter of the asked word that differs is one of ``low .. high - 1``
        or, where ``high`` is its length, what the found word has behind it.
        """
        length = self.lengths[asked]
        forwards = low >= length - high
        asked_left, low_left, high_left = asked[forwards], low[forwards], high[forwards]
        found = self._extend(self.leftwards, self.rightwards, False, asked_left, low_left, high_left)
        back = ~forwards
        # Read backwards, the first difference may lie further on, as with an "a"
        # more in "aaab"; such pairs count by the first difference read forwards.
        one, other, at = self._extend(
            self.rightwards, self.leftwards, True, asked[back], length[back] - high[back], length[back], np.flatnonzero(back)
        )
        first = self.same_ahead(one, other)
        mine = (low[at] <= first) & (first < high[at])
        return np.concatenate([found[0], one[mine]]), np.concatenate([found[1], other[mine]])

    def _extend(self, inner: Direction, outer: Direction, mirrored: bool, asked, low, high, names=None):
        """Search from the exact letters ahead of ``low``, with the error in ``low .. high - 1``.

        ``inner`` prepends and ``outer`` appends; mirrored, words are read backwards.
        With ``names`` of the searches, those of the finds come third.
        """
        length = self.lengths[asked]
        count = len(asked)
        rows = np.arange(count)
        # The exact half, from its inner end to the delimiter, moving both intervals.
        start = np.zeros(count, dtype=np.int64)
        turned = np.zeros(count, dtype=np.int64)
        size = np.full(count, len(self.codes), dtype=np.int64)
        for step in range(int(low.max(initial=-1)) + 1):
            live = np.flatnonzero(low >= step)
            letter = self.letter(asked[live], low[live] - 1 - step, mirrored)
            a, z = start[live], start[live] + size[live]
            turned[live] += inner.smaller(z, letter) - inner.smaller(a, letter)
            ahead = inner.occurs(a, letter)
            size[live] = inner.occurs(z, letter) - ahead
            start[live] = inner.first[letter] + ahead
        # Across the other half without an error so far; every other letter is one.
        found = []
        place = low.copy()
        alone = size < 2  # none but the word itself
        rows, turned, size, place = rows[~alone], turned[~alone], size[~alone], place[~alone]
        while len(rows):
            before = outer.every(turned)
            ahead = outer.every(turned + size) - before
            letter = self.letter(asked[rows], place, mirrored)
            own = np.arange(len(rows))
            start, size = outer.first[letter] + before[own, letter], ahead[own, letter].astype(np.int64)
            ahead[own, letter] = 0
            ahead[:, 0] = 0
            at, other = np.nonzero(ahead)
            begin = outer.first[other] + before[at, other]
            grown = ahead[at, other].astype(np.int64)
            replaced = place[at] < length[rows[at]]
            found.append((rows[at], begin, grown, place[at]))
            found.append((rows[at][replaced], begin[replaced], grown[replaced], place[at][replaced] + 1))
            on = (place < high[rows] - 1) | ((high[rows] == length[rows]) & (place < length[rows]))
            on &= size > 1
            rows, turned, size, place = rows[on], start[on], size[on], place[on] + 1
        found.append((np.zeros(0, dtype=np.int64),) * 4)
        rows, turned, size, place = (np.concatenate(c) for c in zip(*found))
        # The rest of the word and its delimiter, exactly.
        done = [(np.zeros(0, dtype=np.int64),) * 2]
        while len(rows):
            letter = self.letter(asked[rows], place, mirrored)
            ahead = outer.occurs(turned, letter)
            size = outer.occurs(turned + size, letter) - ahead
            turned = outer.first[letter] + ahead
            over = (place == length[rows]) & (size > 0)
            done.append((rows[over], turned[over]))
            on = (place < length[rows]) & (size > 0)
            rows, turned, size, place = rows[on], turned[on], size[on], place[on] + 1
        rows, turned = (np.concatenate(c) for c in zip(*done))
        at = outer.order[turned]  # of the delimiter behind, in reading direction
        at = at if mirrored else len(self.codes) - 1 - at
        word = np.searchsorted(self.starts, at, side="right") - (0 if mirrored else 1)
        return (asked[rows], word) if names is None else (asked[rows], word, names[rows])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words per word, bucket by bucket: how many, and the commonest; rows come by bucket."""
    held: list[pa.RecordBatch] = []
    bucket = None
    for batch in batches:
        numbers = batch.column(0).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, [len(numbers)]])
        for a, z in zip(cuts[:-1], cuts[1:]):
            if z > a:
                if held and numbers[a] != bucket:
                    yield from _near(held)
                    held = []
                bucket = numbers[a]
                held.append(batch.slice(a, z - a))
    if held:
        yield from _near(held)


def _near(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held)
    _, group, size = np.unique(rows.column("key").to_numpy(), return_inverse=True, return_counts=True)
    rows = rows.filter(pa.array(size[group] > 1))
    if not len(rows):
        return
    texts = rows.column("word").to_pylist()
    words = sorted(set(texts))
    number = {word: i for i, word in enumerate(words)}
    index = np.array([number[text] for text in texts])
    count = np.zeros(len(words), dtype=np.int64)
    count[index] = rows.column("n").to_numpy()
    asked = rows.column("asked").to_numpy(zero_copy_only=False)
    low, high = (rows.column(c).to_numpy().astype(np.int64)[asked] for c in ("low", "high"))
    vocabulary = Vocabulary(words)
    one, other = vocabulary.pairs(index[asked], low, high)
    # Words of one length ask for each other; a longer one does not ask.
    longer = vocabulary.lengths[other] > vocabulary.lengths[one]
    one, other = np.concatenate([one, other[longer]]), np.concatenate([other, one[longer]])
    order = np.lexsort((other, -count[other], one))
    one, other = one[order], other[order]
    heads = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]])) if len(one) else one
    near = np.diff(np.append(heads, len(one)))
    arrays = [
        pa.array([words[i] for i in one[heads]], pa.string()),
        pa.array(near.astype(np.int64)),
        pa.array(count[other[heads]]),
        pa.array([words[i] for i in other[heads]], pa.string()),
    ]
    yield pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "near_n", "near"])


def _regions(vocabulary: DataFrame) -> DataFrame:
    """Where the error may lie: either half of the shorter word, for words asked and those one longer."""
    length = F.length("word")
    bands = F.filter(
        F.array(
            F.struct(length.alias("band"), F.lit(True).alias("asked")),
            F.struct((length - 1).alias("band"), F.lit(False).alias("asked")),
        ),
        lambda b: b["band"] > 0,
    )
    rows = vocabulary.select("word", "n", F.explode(bands).alias("_b")).select("word", "n", "_b.band", "_b.asked")
    half = F.floor(F.col("band") / 2).cast("int")
    return _split(rows.withColumns({"low": F.lit(0), "high": F.col("band"), "_cut": half}))


def _split(rows: DataFrame) -> DataFrame:
    """Each region in two at ``_cut``; one of a single letter stays."""
    parts = F.array(
        F.struct(F.col("low").alias("low"), F.col("_cut").alias("high")),
        F.struct(F.col("_cut").alias("low"), F.col("high").alias("high")),
    )
    parts = F.filter(parts, lambda p: p["high"] > p["low"])
    return rows.select("word", "n", "band", "asked", F.explode(parts).alias("_r")).select(
        "word", "n", "band", "asked", "_r.low", "_r.high"
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """With a key of the exact letters on both sides of the region."""
    outside = (F.left("word", F.col("low")), F.right("word", F.col("band") - F.col("high")))
    return rows.withColumn("key", F.xxhash64("band", "low", "high", *outside))


def count_words(tokens: DataFrame, word_col: str, least: int, least_length: int) -> DataFrame:
    """``word, n``: words of ``least_length`` characters or more with ``least`` rows or more."""
    word = F.col(word_col).cast("string")
    long = tokens.select(word.alias("word")).where(F.length("word") >= max(least_length, 1))
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word, n_near, near_n, near`` in parts: near words found in one bucket, and the commonest.

    ``vocabulary`` is a settled table of distinct ``word`` with ``n``. A pair of
    near words is found in exactly one bucket, so the parts of a word add up.
    Groups of more than ``GROUP`` words with one exact half are split: the error
    lies in one half of the rest, and the other half of it is exact too. What is
    left at the end are groups whose words differ in one letter.
    """
    spark = vocabulary.sparkSession
    bound_batches(spark)
    rows, settled = _regions(vocabulary), []
    while True:
        keyed = _keyed(rows)
        sizes = keyed.where(F.col("high") - F.col("low") > 1).groupBy("key").count()
        crowded = settle(sizes.where(F.col("count") > GROUP).select("key"), "variant-groups")
        if crowded.isEmpty():
            settled.append(keyed)
            break
        settled.append(keyed.join(crowded, "key", "left_anti").select(keyed.columns))
        halved = keyed.join(crowded, "key", "left_semi")
        halved = halved.withColumn("_cut", F.floor((F.col("low") + F.col("high")) / 2).cast("int"))
        rows = settle(_split(halved), "variant-regions")
    every = settled[0]
    for more in settled[1:]:
        every = every.unionByName(more)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    letters = vocabulary.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    buckets = max(parts, 4 * letters // LETTERS)  # a word is in four groups
    dealt = every.select(
        F.pmod("key", F.lit(buckets)).alias("bucket"), "key", "word", "n", "low", "high", "asked"
    ).repartition(max(parts, buckets // 8), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_search, PARTIAL)


def group_variants(
    tokens: DataFrame, word_col: str = "word", least: int = 5, least_length: int = 6, ratio: int = 5
) -> DataFrame:
    """A row per word: ``word, n, form, form_n, n_near, root``; ``tokens`` has a row per occurrence.

    Words are values of ``least_length`` characters or more found ``least`` times
    or more; NULL and empty values are none, other columns are not looked at. Two
    words are near if one inserted, deleted or replaced character makes them
    equal. The form is the near word with the largest ``n`` (the first in code
    point order of several), if that is ``ratio`` times the word's own or more;
    else NULL, like ``form_n``. ``n_near`` counts the near words. The root is
    reached by following forms to the last; the word itself without one. ``ratio``
    is above 1, so that forms never lead back. No rows give no rows.
    """
    if ratio <= 1:
        raise ValueError("a form has to be commoner than its word")
    vocabulary = settle(count_words(tokens, word_col, least, least_length), "variant-words")
    best = F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))
    found = near_words(vocabulary).select(
        "word", F.lit(None).cast("bigint").alias("n"), "n_near", best.alias("best")
    )
    none = F.lit(None).cast("struct<n:bigint,word:string>")
    own = vocabulary.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), none.alias("best"))
    joined = own.unionByName(found).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    form = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best.word"))
    words = settle(
        joined.select(
            "word", "n", form.alias("form"), F.when(form.isNotNull(), -F.col("best.n")).alias("form_n"), "n_near"
        ),
        "variant-forms",
    )
    roots = _roots(words.where(F.col("form").isNotNull()).select(F.col("word").alias("_word"), F.col("form").alias("_root")))
    return words.join(roots, words["word"] == roots["_word"], "left").select(
        *words.columns, F.coalesce("_root", "word").alias("root")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``_word, _root`` from words and their forms; every round doubles the steps taken."""
    forms = settle(forms, "variant-roots")
    while True:
        on = forms.select(F.col("_word").alias("_from"), F.col("_root").alias("_to"))
        moved = forms.join(on, F.col("_root") == F.col("_from"), "left")
        moved = settle(
            moved.select("_word", F.coalesce("_to", "_root").alias("_root"), F.col("_to").isNotNull().alias("_moved")),
            "variant-roots",
        )
        forms = moved.select("_word", "_root")
        if moved.where("_moved").isEmpty():
            return forms
