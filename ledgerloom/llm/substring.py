"""Passages that repeat across documents are removed from all but the first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.packed import SCHEMA, by_bucket, pack, to_batch, unpack
from ledgerloom.llm.words import (
    Words,
    chunks,
    mix,
    ranges,
    split_words,
    window_hashes,
    within_text,
    word_chunks,
)
from ledgerloom.operators.sketches import key_filter, may_be_key
from ledgerloom.session import settle

# Words per window, and per minimiser.
WINDOW = 13
MINIMISER = 3
# Packed bytes of a bucket, about; slots of minimisers per bucket.
BUCKET_BYTES = 4 << 20
# Packed bytes that a task gathers before it deals them to the buckets.
GATHERED = 16 << 20
# Zstandard level of the rows that go to the buckets: what shuffles is the bulk of all data.
LEVEL = 6
SLOTS = 16
# Bits of the filter that tells which texts have runs: about 1 in 16 others passes
# it at six million texts with runs.
FILTER_BITS = 1 << 25
# An id that sorts behind all others stands in for NULL.
NO_ID = (1 << 63) - 1

RUNS = "id bigint, mark bigint, start bigint, windows bigint"


def _same_words(words: np.ndarray, one: np.ndarray, other: np.ndarray, width: int) -> np.ndarray:
    """Whether windows starting at two words have equal words throughout."""
    same = np.ones(len(one), dtype=bool)
    for i in range(width):
        same &= words[one + i] == words[other + i]
    return same


def _later(words: np.ndarray, begin: np.ndarray, hashes: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
    """Windows whose words also start in a document with a smaller id, of those given.

    Sorts the windows by hash. Should different windows share a hash, their
    groups are taken apart word by word.
    """
    later = np.zeros(len(begin), dtype=bool)
    todo = np.arange(len(begin))
    while len(todo):
        order = todo[np.argsort(hashes[todo], kind="stable")]
        new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        order, size = order[np.repeat(size > 1, size)], size[size > 1]
        if not len(order):
            break
        at = np.cumsum(size) - size
        head = np.repeat(order[at], size)
        same = _same_words(words, begin[order], begin[head], width)
        least = np.minimum.reduceat(np.where(same, ids[order], NO_ID), at)
        later[order] = same & (ids[order] > np.repeat(least, size))
        todo = order[~same]
    return later


class Windows:
    """Windows of consecutive texts, and the slot each one's minimiser falls into."""

    def __init__(self, words: Words, ids: np.ndarray, slots: int, width: int = WINDOW):
        self.begin = within_text(words.first, width)
        text = np.repeat(np.arange(len(ids)), np.maximum(words.counts() - width + 1, 0))
        self.text = text
        self.place = self.begin - words.first[text]
        self.hash = window_hashes(words.hash, width)[self.begin]
        self.later = _later(words.hash, self.begin, self.hash, ids[text], width)
        size = min(MINIMISER, width)
        grams = window_hashes(words.hash, size)
        least = grams[self.begin]
        for i in range(1, width - size + 1):
            np.minimum(least, grams[self.begin + i], out=least)
        self.minimiser = least
        self.slot = (mix(least) % np.uint64(slots)).astype(np.int64)


def _runs(windows: Windows, rows: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of windows of the super-k-mers among ``rows``.

    Windows in a row with one minimiser travel together, those marked ``alone``
    each by itself.
    """
    if not len(rows):
        return rows, rows
    begin, least = windows.begin[rows], windows.minimiser[rows]
    cut = np.ones(len(rows), dtype=bool)
    cut[1:] = (begin[1:] != begin[:-1] + 1) | (least[1:] != least[:-1]) | alone[1:] | alone[:-1]
    cut[1:] |= windows.text[rows][1:] != windows.text[rows][:-1]
    at = np.flatnonzero(cut)
    return rows[at], np.diff(np.append(at, len(rows)))


def _loads(slots: int, width: int):
    """Windows per slot that would travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, end, _, _, words in word_chunks(batch.column(2), False):
                windows = Windows(words, ids[first:end], slots, width)
                total += np.bincount(windows.slot[~windows.later], minlength=slots)
        used = np.flatnonzero(total)
        for a in range(0, len(used), 1 << 16):
            part = used[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["slot", "n"])

    return run


def _dealt(runs: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Gathered super-k-mers as one packed row per bucket."""
    key, own, mark, place, length, data = (np.concatenate(c) for c in zip(*runs))
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.cumsum(length, dtype=np.int64) - length
    data = data[ranges(starts[order], length[order].astype(np.int64))]
    bucket, own, mark, place, length = (c[order] for c in (bucket, own, mark, place, length))
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = np.append(cuts[1:], len(bucket))
    bytes_at = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
    rows = []
    for a, z in zip(cuts.tolist(), ends.tolist()):
        part = [own[a:z], mark[a:z], place[a:z], length[a:z], data[bytes_at[a] : bytes_at[z]]]
        rows.append((int(bucket[a]), pack(part, LEVEL)))
        if len(rows) >= 256:
            yield to_batch(rows)
            rows = []
    if rows:
        yield to_batch(rows)


def _send(sent, slots: int, buckets: int, width: int):
    """Packed super-k-mers per bucket; runs known to repeat already go to bucket -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded = np.zeros(slots, dtype=bool)
        crowded[sent.value] = True
        runs: list[tuple] = []
        gathered = 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            marks = batch.column(1).to_numpy(zero_copy_only=False)
            for first, end, data, _, words in word_chunks(batch.column(2), False):
                own, mark = ids[first:end], marks[first:end].astype(np.int32)
                windows = Windows(words, own, slots, width)
                rows = np.flatnonzero(~windows.later)
                at, size = _runs(windows, rows, crowded[windows.slot[rows]])
                key = np.where(
                    crowded[windows.slot[at]], windows.hash[at], mix(windows.slot[at].astype(np.uint64))
                )
                left = words.start[windows.begin[at]]
                length = words.end[windows.begin[at] + size - 1 + width - 1] - left
                text = windows.text[at]
                packed = data[ranges(left, length)]
                runs.append(
                    (key, own[text], mark[text], windows.place[at].astype(np.uint32), length.astype(np.uint32), packed)
                )
                gathered += len(packed)
                if gathered >= GATHERED:
                    yield from _dealt(runs, buckets)
                    runs, gathered = [], 0
                known = np.flatnonzero(windows.later)
                cut = np.ones(len(known), dtype=bool)
                cut[1:] = windows.begin[known][1:] != windows.begin[known][:-1] + 1
                cut[1:] |= windows.text[known][1:] != windows.text[known][:-1]
                starts = np.flatnonzero(cut)
                if len(starts):
                    count = np.diff(np.append(starts, len(known)))
                    text = windows.text[known[starts]]
                    yield to_batch([(-1, pack([own[text], mark[text], windows.place[known[starts]], count]))])
        if gathered:
            yield from _dealt(runs, buckets)

    return run


def _run_batch(ids, marks, starts, counts) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(a, dtype=np.int64)) for a in (ids, marks, starts, counts)]
    return pa.RecordBatch.from_arrays(arrays, ["id", "mark", "start", "windows"])


def _known_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(1):
            yield _run_batch(*unpack(packed.as_py()))


def _count(width: int):
    """Runs of windows of a bucket that start in a document with a smaller id too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in by_bucket(batches):
            ids, marks, places, lengths, data = (np.concatenate(c) for c in zip(*parts))
            places = places.astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            hashes, counts = [], []
            for a, z in chunks(offsets):
                words = split_words(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a])
                hashes.append(words.hash)
                counts.append(words.counts())
            words, count = np.concatenate(hashes), np.concatenate(counts)
            first = np.concatenate([[0], np.cumsum(count)])
            begin = within_text(first, width)
            run_of = np.repeat(np.arange(len(ids)), np.maximum(count - width + 1, 0))
            later = _later(words, begin, window_hashes(words, width)[begin], ids[run_of], width)
            hit = np.flatnonzero(later)
            if len(hit):
                cut = np.ones(len(hit), dtype=bool)
                cut[1:] = (begin[hit][1:] != begin[hit][:-1] + 1) | (run_of[hit][1:] != run_of[hit][:-1])
                at = np.flatnonzero(cut)
                number = np.diff(np.append(at, len(hit)))
                of = run_of[hit[at]]
                place = places[of] + begin[hit[at]] - first[of]
                yield _run_batch(ids[of], marks[of], place, number)

    return run


def _removed(count: int, starts: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    edge = np.zeros(count + 1, dtype=np.int64)
    np.add.at(edge, np.minimum(starts, count), 1)
    np.add.at(edge, np.minimum(starts + windows + width - 1, count), -1)
    return np.cumsum(edge[:-1]) > 0


def _rewrite(position: int, kept_names: list[str], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*kept_names, "n_words", "n_removed", "kept_text"]
        for batch in batches:
            runs = batch.column(len(kept_names)).to_pylist()
            numbers, gone, texts = [], [], []
            for first, end, data, _, words in word_chunks(batch.column(position), False):
                raw = data.tobytes()
                for text in range(first, end):
                    a, z = words.first[text - first], words.first[text - first + 1]
                    start, stop = words.start[a:z], words.end[a:z]
                    if runs[text]:
                        starts = np.array([r["start"] for r in runs[text]])
                        removed = _removed(z - a, starts, np.array([r["windows"] for r in runs[text]]), width)
                        start, stop = start[~removed], stop[~removed]
                    numbers.append(int(z - a))
                    gone.append(int(z - a) - len(start))
                    texts.append(b" ".join([raw[i:j] for i, j in zip(start.tolist(), stop.tolist())]))
            texts = pa.array(texts, pa.binary()).cast(pa.string())
            arrays = [*batch.columns[: len(kept_names)], pa.array(numbers, pa.int64()), pa.array(gone, pa.int64()), texts]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _mark(text_col: str) -> Column:
    """32 bits that tell texts with one id apart."""
    return F.xxhash64(text_col).bitwiseAND(F.lit(0x7FFFFFFF))


def drop_repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` added.

    A window is ``width`` consecutive words of one text. Every word covered by a
    window whose words also start in a document with a smaller id is removed;
    windows are judged on the input. The kept words are joined by one space. A
    NULL text has no words. Rows with equal ids never remove from each other;
    rows without an id come after all others. An input column named like an
    added one is replaced. No rows give no rows.

    Windows in a row that share a minimiser travel as one packed string to its
    bucket, where a sort finds the first of equal windows. A window that repeats
    inside a task's chunk travels once, for its smallest id there, so a passage
    found in a third of all documents is few rows. Minimisers that would fill a
    bucket are dealt out by the whole window instead; there are at most as many
    as buckets. Windows are equal when all their words' 64-bit hashes are. Texts
    shuffle only if a filter of fixed size does not rule out that they have runs.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kept_names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("_id"),
        _mark(text_col).alias("_mark"),
        F.col(text_col).alias("_text"),
    )
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, 3 * size // BUCKET_BYTES, 1)
    slots = 1 << (SLOTS * buckets - 1).bit_length()
    loads = texts.mapInArrow(_loads(slots, width), "slot bigint, n bigint")
    loads = settle(loads.groupBy("slot").agg(F.sum("n").alias("n")), "slot-loads")
    total = loads.agg(F.sum("n")).first()[0] or 0
    # More than a bucket's share each, so fewer than there are buckets.
    crowded = [row.slot for row in loads.where(F.col("n") > total / buckets).select("slot").collect()]
    sent = spark.sparkContext.broadcast(np.array(crowded, dtype=np.int64))
    packed = texts.mapInArrow(_send(sent, slots, buckets, width), SCHEMA)
    dealt = packed.repartition(
        max(parts, buckets // 4), F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.xxhash64("packed"))
    ).sortWithinPartitions("bucket")
    runs = settle(dealt.mapInArrow(_count_all(width), RUNS), "repeated-runs")
    per_text = runs.groupBy(F.col("id").alias("_rid"), F.col("mark").alias("_rmark")).agg(
        F.collect_set(F.struct("start", "windows")).alias("_runs")
    )
    given = docs.withColumns(
        {"_rid": F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)), "_rmark": _mark(text_col)}
    )
    # Texts that surely have no runs stay where they are; the others move to theirs.
    marked = settle(
        key_filter(runs.select(F.xxhash64("id", "mark").alias("key")).distinct(), "key", FILTER_BITS), "run-filter"
    )
    moves = may_be_key(marked, F.xxhash64("_rid", "_rmark"), FILTER_BITS)
    moved = given.where(moves).join(per_text, ["_rid", "_rmark"], "left").select(*kept_names, "_runs")
    none = F.lit(None).cast(per_text.schema["_runs"].dataType).alias("_runs")
    joined = moved.unionAll(given.where(~moves).select(*kept_names, none))
    schema = docs.select(*kept_names).withColumns(
        {"n_words": F.lit(0).cast("bigint"), "n_removed": F.lit(0).cast("bigint"), "kept_text": F.lit("")}
    ).schema
    return joined.mapInArrow(_rewrite(kept_names.index(text_col), kept_names, width), schema)


def _count_all(width: int):
    count = _count(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def others() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = batch.column(0).to_numpy(zero_copy_only=False) < 0
                ready.extend(_known_runs([batch.filter(pa.array(known))]))
                yield batch.filter(pa.array(~known))

        ready: list[pa.RecordBatch] = []
        for found in count(others()):
            while ready:
                yield ready.pop()
            yield found
        yield from ready

    return run
