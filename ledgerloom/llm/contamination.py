"""Benchmark questions found in documents, also with other numbers, names or units."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.sending import received, send
from ledgerloom.llm.words import (
    CHUNK,
    LOWER,
    Hasher,
    chunks,
    hash_bytes,
    mix,
    split_words,
    text_bytes,
    window_hashes,
)

# Words that name a unit.
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles meter meters metre "
    "metres mg g kg gram grams kilogram kilograms oz ounce ounces lb lbs pound pounds ton tons ml "
    "cl l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr "
    "hour hours day days week weeks month months year years dollar dollars cent cents euro euros "
    "usd eur gbp yen percent degree degrees celsius fahrenheit kelvin joule joules watt watts volt "
    "volts km/h mph"
).split()

# Words per template window, and plain words it needs to stand without equal slots.
WINDOW = 8
PLAIN = 3
# Share of an item's words that consistent windows have to cover in a document.
SHARE = 0.5
# Benchmark words matched in one pass over the documents; more take more passes.
BLOCK_WORDS = 1 << 21

PLAIN_WORD, NUMBER, NAME, UNIT = range(4)

PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[ord(c) for c in "!\"#&'()*,-.:;<=>?@[\\]^_`{|}~$%+/"]] = True
STOPS = np.zeros(256, dtype=bool)
STOPS[[ord(c) for c in ".!?"]] = True


class Template(NamedTuple):
    """Words of consecutive texts with numbers, names and units typed."""

    first: np.ndarray
    kind: np.ndarray
    canonical: np.ndarray  # hash of the lower-cased word, or of its type
    value: np.ndarray  # hash of the lower-cased word


def canonicalise(data: np.ndarray, offsets: np.ndarray) -> Template:
    """Template words of texts laid end to end.

    A word loses punctuation at its ends. One that then starts with a digit is a
    number, a listed one a unit, and a capitalised one that does not start a
    sentence a name; words in capitals throughout are plain.
    """
    lower = LOWER[data]
    # Capital Latin letters of two bytes, À to Þ, lie 32 below their small ones.
    capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    lower[1:][capital] += 32
    hasher = Hasher(lower)
    words = split_words(lower, offsets, hasher)
    start, end = words.start.copy(), words.end.copy()
    while True:
        trim = (start < end) & PUNCTUATION[data[np.minimum(start, len(data) - 1)]]
        if not trim.any():
            break
        start[trim] += 1
    while True:
        trim = (start < end) & PUNCTUATION[data[end - 1]]
        if not trim.any():
            break
        end[trim] -= 1
    bare = start == end  # punctuation only: taken as it is
    start, end = np.where(bare, words.start, start), np.where(bare, words.end, end)
    value = hasher.of(start, end)
    kind = np.zeros(len(start), dtype=np.int8)
    if len(start):
        head = data[start]
        wide = (head == 0xC3) & (start + 1 < end)
        second = np.minimum(start + 1, len(data) - 1)
        after = np.minimum(start + 1 + wide, len(data) - 1)
        # Capitalised: the first letter is a capital and the second is not, so `A` and `USA` are words.
        capital = np.where(wide, lower[second] != data[second], (head >= 65) & (head <= 90))
        small = (data[after] >= 97) & (data[after] <= 122) | (data[after] == 0xC3) & (
            lower[np.minimum(after + 1, len(data) - 1)] == data[np.minimum(after + 1, len(data) - 1)]
        )
        capital &= small & (after < end)
        opens = np.zeros(len(start), dtype=bool)
        opens[1:] = STOPS[data[words.end[:-1] - 1]]
        at = words.first[:-1]
        opens[at[at < len(start)]] = True
        kind[capital & ~opens & ~bare] = NAME
        kind[np.isin(value, np.array([hash_bytes(u.encode()) for u in UNITS], dtype=np.uint64))] = UNIT
        kind[(head >= 48) & (head <= 57)] = NUMBER
    typed = np.array([0, 11, 13, 17], dtype=np.uint64)[kind]
    canonical = np.where(kind == PLAIN_WORD, value, mix(typed))
    return Template(words.first, kind, canonical, value)


class Benchmark(NamedTuple):
    """Items and their windows, the windows sorted by hash."""

    ids: np.ndarray
    words: Template
    widths: list[int]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray


def windows_of(template: Template, width: int, only: np.ndarray | None = None):
    """``hash, text, index of the first word`` of the windows of ``width`` words.

    With ``only``: of the texts marked there.
    """
    hashes = window_hashes(template.canonical, width) + np.uint64(width)
    counts = np.diff(template.first)
    sizes = np.maximum(counts - width + 1, 0)
    if only is not None:
        sizes = np.where(only, sizes, 0)
    text = np.repeat(np.arange(len(counts)), sizes)
    begin = np.repeat(template.first[:-1] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return hashes[begin], text, begin


def index_items(ids: list[int], texts: list[str], width: int = WINDOW) -> Benchmark:
    """Windows of the items; an item shorter than a window is one window as it is.

    Windows with names are listed a second time with the names as plain words,
    for texts in which nothing or everything is capitalised.
    """
    words = canonicalise(*text_bytes(pa.array(texts, pa.large_string())))
    counts = np.diff(words.first)
    widths = sorted({width, *counts[(counts > 0) & (counts < width)].tolist()})
    unnamed = words._replace(canonical=np.where(words.kind == NAME, words.value, words.canonical))
    parts = []
    for w in widths:
        only = None if w == width else counts == w
        typed, plain = windows_of(words, w, only), windows_of(unnamed, w, only)
        other = typed[0] != plain[0]
        parts += [typed, tuple(column[other] for column in plain)]
    hashes, item, place = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(hashes, kind="stable")
    return Benchmark(np.array(ids, dtype=np.int64), words, widths, hashes[order], item[order], place[order])


def _consistent(bench: Benchmark, doc: Template, pairs: list[tuple[int, int]]) -> bool:
    """Slots of aligned words: each value stands for one value, per type and both ways.

    Where there are too few plain words, all slots have to be equal.
    """
    ahead: dict[tuple[int, int], int] = {}
    back: dict[tuple[int, int], int] = {}
    plain, equal = 0, True
    for i, j in pairs:
        kind = int(bench.words.kind[i])
        if kind == PLAIN_WORD:
            plain += 1
            continue
        ours, theirs = int(bench.words.value[i]), int(doc.value[j])
        equal = equal and ours == theirs
        if ahead.setdefault((kind, ours), theirs) != theirs:
            return False
        if back.setdefault((kind, theirs), ours) != ours:
            return False
    return equal or plain >= PLAIN


def matches(bench: Benchmark, doc: Template, verbatim: bool = False) -> dict[int, list[tuple[int, float, int]]]:
    """Per text its ``(item id, share covered, words covered)``, consistent windows only.

    With ``verbatim`` also those of inconsistent passages whose words are all equal.
    """
    found: dict[tuple[int, int], dict[int, list[tuple[int, int]]]] = {}
    for width in bench.widths:
        hashes, text, begin = windows_of(doc, width)
        left = np.searchsorted(bench.hashes, hashes, side="left")
        inside = left < len(bench.hashes)
        inside[inside] = bench.hashes[left[inside]] == hashes[inside]
        hits = np.flatnonzero(inside)
        right = np.searchsorted(bench.hashes, hashes[hits], side="right")
        for hit, a, z in zip(hits, left[hits], right):
            for row in range(a, z):
                place, at = int(bench.place[row]), int(begin[hit])
                group = found.setdefault((int(text[hit]), int(bench.item[row])), {})
                group.setdefault(at - place, []).append((place, width))
    out: dict[int, list[tuple[int, float, int]]] = {}
    for (text, item), shifts in found.items():
        covered: set[int] = set()
        for shift, runs in shifts.items():
            # Windows that overlap or touch are one passage with one set of slots.
            passage: list[int] = []
            for place, width in sorted(runs):
                if passage and place > passage[-1] + 1:
                    covered.update(_kept(bench, doc, passage, shift, verbatim))
                    passage = []
                passage += range(max(place, passage[-1] + 1) if passage else place, place + width)
            covered.update(_kept(bench, doc, passage, shift, verbatim))
        size = int(bench.words.first[item + 1] - bench.words.first[item])
        if covered:
            out.setdefault(text, []).append((int(bench.ids[item]), len(covered) / size, len(covered)))
    return out


def _kept(bench: Benchmark, doc: Template, passage: list[int], shift: int, verbatim: bool) -> list[int]:
    pairs = [(i, i + shift) for i in passage]
    if _consistent(bench, doc, pairs):
        return passage
    return _equal_windows(bench, doc, pairs) if verbatim else []


def _equal_windows(bench: Benchmark, doc: Template, pairs: list[tuple[int, int]]) -> list[int]:
    """Words of a passage that lie in a window of equal words."""
    out: list[int] = []
    run: list[int] = []
    for i, j in [*pairs, (-1, -1)]:
        if i >= 0 and bench.words.value[i] == doc.value[j]:
            run.append(i)
            continue
        out += run if len(run) >= WINDOW else []
        run = []
    return out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    into: str = "leaks",
    share: float = SHARE,
    block_words: int = BLOCK_WORDS,
    verbatim: bool = False,
) -> DataFrame:
    """``docs`` with the benchmark items each whole text holds: ``item_id, share, words``.

    Words become templates: numbers, names and units turn into their types. A
    window of `WINDOW` words of a text that equals one of an item joins them by
    hash; windows in a row are one passage, which counts if its slots agree,
    each value standing for one value both ways. With ``verbatim``, of a passage
    whose slots conflict the windows count whose words are all the item's own,
    so an item with one value altered is found by the words around it. ``share``
    is the part of the item's words that have to be covered. NULL and empty texts hold
    nothing, items without words or with a NULL id are found nowhere, repeated
    items once. An input column named like the result is replaced. The documents
    do not shuffle; the benchmark is sent to them in blocks of whole items with
    at most ``block_words`` words (or one item), one pass per block.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != into]
    out = docs.select(*kept)
    kind = "array<struct<item_id: bigint, share: double, words: bigint>>"
    out = out.withColumn(into, F.array().cast(kind))
    position = kept.index(text_col)
    schema = out.schema
    items = (
        benchmark.where(F.col(item_col).isNotNull())
        .select(F.col(item_col).cast("bigint").alias("id"), F.col(item_text).alias("text"))
        .where(F.coalesce(F.length(F.trim("text")), F.lit(0)) > 0)
        .distinct()
    )
    leak = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64()), ("words", pa.int64())]))

    def search(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bench = received(sent)
            for batch in batches:
                data, offsets = text_bytes(batch.column(position))
                earlier = batch.column(len(kept)).to_pylist()
                for first, end in chunks(offsets, CHUNK):
                    part = data[offsets[first] : offsets[end]]
                    template = canonicalise(part, offsets[first : end + 1] - offsets[first])
                    for text, hits in matches(bench, template, verbatim).items():
                        good = [h for h in hits if h[1] >= share]
                        earlier[first + text] += [
                            {"item_id": i, "share": s, "words": w} for i, s, w in sorted(good)
                        ]
                arrays = [*batch.columns[: len(kept)], pa.array(earlier, leak)]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, into])

        return run

    context = docs.sparkSession.sparkContext
    ids: list[int] = []
    texts: list[str] = []
    size = 0
    for row in items.orderBy("id", "text").toLocalIterator():
        words = len(row.text.split())
        if ids and size + words > block_words:
            out = out.mapInArrow(search(send(context, index_items(ids, texts))), schema)
            ids, texts, size = [], [], 0
        ids.append(row.id)
        texts.append(row.text)
        size += words
    if ids:
        out = out.mapInArrow(search(send(context, index_items(ids, texts))), schema)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that hold a benchmark item; columns as given."""
    found = find_leaks(docs, benchmark, into="_leaks", **options)
    return found.where(F.size("_leaks") == 0).drop("_leaks")
