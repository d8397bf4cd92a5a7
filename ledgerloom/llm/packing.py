"""Documents packed into bins of fixed size, tightest compatible bin first."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.words import BASE, mix, word_chunks

# Words per bin, documents of one source per bin, documents packed together.
CAPACITY = 2048
PER_SOURCE = 4
SHARD_ROWS = 4096

RESULT = (
    "doc_id bigint, piece int, first_word bigint, n_words bigint, bin_id bigint, place int"
)


class Packer:
    """Open bins ordered by what is left in them, with bitmaps of what they hold.

    ``planes[k]`` of a bin has a source's bit set when the bin holds more than k
    documents of it; ``clusters`` has the bits of its duplicate clusters.
    """

    def __init__(self, capacity: int = CAPACITY, per_source: int = PER_SOURCE):
        self.capacity = capacity
        self.per_source = per_source
        self.order: list[tuple[int, int]] = []  # (left, bin), ascending
        self.planes: list[list[int]] = []
        self.clusters: list[int] = []
        self.held: list[int] = []

    def open(self) -> int:
        self.planes.append([0] * self.per_source)
        self.clusters.append(0)
        self.held.append(0)
        return len(self.held) - 1

    def add(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """``bin, place`` of an item; ``source`` and ``cluster`` are single bits or 0."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            left, number = self.order[at]
            if not (self.planes[number][-1] & source or self.clusters[number] & cluster):
                del self.order[at]
                break
            at += 1  # the successor: the next tightest bin
        else:
            left, number = self.capacity, self.open()
        for plane in range(self.per_source):
            if not self.planes[number][plane] & source:
                self.planes[number][plane] |= source
                break
        self.clusters[number] |= cluster
        place = self.held[number]
        self.held[number] += 1
        if left > size:
            insort(self.order, (left - size, number))
        return number, place

    def fill(self) -> int:
        """A bin of its own for a piece that fills it."""
        number = self.open()
        self.held[number] = 1
        return number


def pack_items(items: list[tuple[int, int, object, object]], capacity: int, per_source: int):
    """``item, piece, first word, words, bin, place``; items are ``id, words, source, cluster``."""
    packer = Packer(capacity, per_source)
    sources: dict[object, int] = {}
    times: dict[object, int] = {}
    for _, _, _, cluster in items:
        times[cluster] = times.get(cluster, 0) + 1
    # Only clusters with several items here can conflict; each gets a bit of its own.
    bits = {c: 1 << i for i, c in enumerate(c for c, n in times.items() if n > 1 and c is not None)}
    order = []
    for i, (_, words, _, _) in enumerate(items):
        for piece in range(words // capacity):
            yield i, piece, piece * capacity, capacity, packer.fill(), 0
        if words % capacity:
            order.append(i)
        elif not words:
            yield i, 0, 0, 0, None, None
    order.sort(key=lambda i: -(items[i][1] % capacity))
    for i in order:
        _, words, source, cluster = items[i]
        bit = 0 if source is None else sources.setdefault(source, 1 << len(sources))
        number, place = packer.add(words % capacity, bit, bits.get(cluster, 0))
        yield i, words // capacity, words - words % capacity, words % capacity, number, place


def _measure(kept: list[str]):
    """Adds words and the hash of all words, A-Z lower-cased, to each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys = [], []
            for _, _, _, _, words in word_chunks(batch.column(len(kept)), True):
                number = words.counts()
                place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], number)
                marks = mix(words.hash + place.astype(np.uint64) * np.uint64(BASE))
                sums = np.concatenate([[np.uint64(0)], np.cumsum(marks, dtype=np.uint64)])
                counts.append(number)
                keys.append((sums[words.first[1:]] - sums[words.first[:-1]]).view(np.int64))
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            arrays = [*batch.columns[: len(kept)], pa.array(counts.astype(np.int64)), pa.array(keys)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "words", "key"])

    return run


def _pack_shards(capacity: int, per_source: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("piece", pa.int32()), ("first_word", pa.int64()),
            ("n_words", pa.int64()), ("bin_id", pa.int64()), ("place", pa.int32()),
        ]
    )

    def packed(shard: int, items: list) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in schema]
        for i, piece, first, words, number, place in pack_items(items, capacity, per_source):
            whole = None if number is None else (shard << 32) | number
            for column, value in zip(columns, (items[i][0], piece, first, words, whole, place)):
                column.append(value)
        arrays = [pa.array(c, field.type) for c, field in zip(columns, schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, items = None, []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if row[0] != shard:
                    if items:
                        yield from packed(shard, items)
                    shard, items = row[0], []
                items.append(row[1:])
        if items:
            yield from packed(shard, items)

    return run


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``doc_id, piece, first_word, n_words, bin_id, place``: where each text goes.

    A text of more than ``capacity`` words fills bins of its own and leaves its
    rest as a last piece. The pieces go by falling size, then id, into the
    fullest bin that has room, holds no document of the same duplicate cluster
    and fewer than ``per_source`` documents of the same source; a new bin is
    opened where there is none. ``cluster_col`` names the clusters, NULL is
    none; without it texts with equal words, A-Z lower-cased, are one. A NULL
    source or cluster conflicts with nothing. Texts without words have one row
    without a bin. Rows with equal ids are packed one by one. No rows give no
    rows.

    Documents are dealt by hash into shards of about ``shard_rows`` that are
    packed apart, so no source or cluster is one task; only ids, sizes, sources
    and clusters shuffle.
    """
    bound_batches(docs.sparkSession)
    total = docs.count()
    shards = max(1, -(-total // shard_rows))
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.lit(None).cast("string")
    given = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(source_col).cast("string").alias("source"),
        cluster.alias("cluster"),
        F.xxhash64(text_col).alias("mark"),
        F.col(text_col).alias("text"),
    )
    kept = ["id", "source", "cluster", "mark"]
    sized = given.mapInArrow(
        _measure(kept), "id bigint, source string, cluster string, mark bigint, words bigint, key bigint"
    )
    key = F.col("cluster") if cluster_col else F.col("key").cast("string")
    items = sized.select(
        F.pmod(F.xxhash64("id", "mark"), F.lit(shards)).alias("shard"),
        "id", "words", "source", key.alias("cluster"), "mark",
    )
    dealt = items.repartition(shards, "shard").sortWithinPartitions("shard", "id", "mark")
    return dealt.mapInArrow(_pack_shards(capacity, per_source), RESULT)
