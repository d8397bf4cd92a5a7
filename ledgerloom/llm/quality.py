"""Quality of texts from averaged subword vectors, learned from labelled documents.

Every word and every 3 to 5 neighbouring characters of a word (its edges count as
characters) own a learned vector, found by hashing. A document is the mean of its
vectors; a softmax over two classes reads it. Both are fitted together by
stochastic gradient descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.words import CHUNK, chunks, split_words, text_bytes
from ledgerloom.session import settle

# Vectors, one more than a power of two for the end of a text, and their length.
BITS = 16
BUCKETS = (1 << BITS) + 1
SIZE = 16
GRAMS = (3, 4, 5)
# Bound of the labelled rows of either label that are learned from.
SAMPLE_ROWS = 2500
EPOCHS = 10
RATE = 2.0
# Bound on the length of one step's gradient.
STEEPEST = 2.0

STRAIGHT = np.arange(256, dtype=np.uint32)
STRAIGHT[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20


class QualityModel(NamedTuple):
    """A number per bucket that its vector adds to the margin, and what is added last.

    ``vectors`` and ``output`` are what was learned: the margin of a vector is its
    product with the difference of the two output rows.
    """

    vectors: np.ndarray
    output: np.ndarray
    offset: float

    def margins(self) -> np.ndarray:
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float64)


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number per character of UTF-8 texts, whitespace as blanks, and the texts' offsets."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = STRAIGHT[data[lead]]
    length = np.diff(np.append(lead, len(data)))
    for k in range(1, 4):
        longer = np.flatnonzero(length > k)
        points[longer] = points[longer] * np.uint32(64) + (data[lead[longer] + k] & 0x3F)
    return points, np.searchsorted(lead, offsets)


def buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``ids, first`` of the words, then of the n-grams of each length.

    ``ids`` are buckets in text order, ``first`` where each text's begin, with
    one more at the end.
    """
    words = split_words(data, offsets)
    yield (words.hash >> np.uint64(64 - BITS)).astype(np.int64), words.first
    points, at = characters(data, offsets)
    # A blank ahead of each text and behind the last: the edges of its outer words.
    points = np.insert(points, at, 32)
    at = at + np.arange(len(at))
    blanks = np.concatenate([[0], np.cumsum(points == 32)])
    hashed = points * np.uint32(0x9E3779B1)
    for size in range(2, max(GRAMS) + 1):
        hashed = (hashed[:-1] ^ (hashed[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + points[size - 1 :]
        if size in GRAMS and len(hashed):
            whole = np.flatnonzero(blanks[size - 1 : -1] == blanks[1 : len(hashed) + 1])
            mixed = hashed[whole] * np.uint32(0xC2B2AE35)
            mixed = (mixed ^ (mixed >> np.uint32(16))) * np.uint32(0x27D4EB2F) + np.uint32(size * 0x165667B1)
            yield (mixed >> np.uint32(32 - BITS)).astype(np.int64), np.searchsorted(whole, at)


def text_margins(column: pa.Array, margins: np.ndarray, offset: float) -> np.ndarray:
    """Margin of each text: the mean of its buckets' margins, and the offset."""
    data, offsets = text_bytes(column)
    out = []
    for a, z in chunks(offsets, CHUNK):
        total, count = np.full(z - a, margins[-1]), np.ones(z - a)
        for ids, first in buckets(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]):
            owner = np.repeat(np.arange(z - a), np.diff(first))
            total += np.bincount(owner, weights=margins[ids], minlength=z - a)
            count += np.diff(first)
        out.append(total / count + offset)
    return np.concatenate(out) if out else np.zeros(0)


def text_buckets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct buckets of each text and their shares in it."""
    data, offsets = text_bytes(column)
    for a, z in chunks(offsets, CHUNK):
        parts = list(buckets(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]))
        for i in range(z - a):
            ids = [ids[first[i] : first[i + 1]] for ids, first in parts]
            found, count = np.unique(np.concatenate([*ids, [BUCKETS - 1]]), return_counts=True)
            yield found.astype(np.int32), (count / count.sum()).astype(np.float32)


def descend(
    texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE
) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and output rows after stochastic gradient descent, one text a step.

    Both labels weigh the same. Rows are shuffled by a fixed seed.
    """
    draw = np.random.default_rng(11)
    vectors = draw.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    output = np.zeros((2, SIZE), dtype=np.float32)
    weight = 1 / np.maximum(np.bincount(labels, minlength=2), 1)
    weight /= weight.max()
    steps = epochs * len(labels)
    done = 0
    for _ in range(epochs):
        for i in draw.permutation(len(labels)):
            ids, shares = texts[i]
            held = vectors[ids]
            mean = shares @ held
            odds = output @ mean
            odds = np.exp(odds - odds.max())
            wrong = odds / odds.sum()
            wrong[labels[i]] -= 1
            wrong *= np.float32(rate * (1 - done / steps) * weight[labels[i]])
            back = wrong @ output
            back *= min(STEEPEST / max(float(np.sqrt(back @ back)), STEEPEST), 1.0)
            output -= np.outer(wrong, mean)
            # A text's buckets are distinct, so that no addition gets lost.
            vectors[ids] = held - np.outer(shares, back)
            done += 1
    return vectors, output


def _sample(docs, labels, id_col, text_col, label_col, usable) -> tuple[DataFrame, dict[int, int]]:
    """At most ``SAMPLE_ROWS`` labelled texts of either label, equal texts once, and all labels' counts."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")
    ).agg(F.max(label_col).cast("int").alias("label"))
    ids = settle(known.where(usable).withColumn("_order", F.xxhash64("_id")), "quality-labels")
    # Two rows at most.
    sizes = {row.label: row["count"] for row in ids.groupBy("label").count().collect()}
    parts = []
    for label, rows in sizes.items():
        # Hashes are even: the least SAMPLE_ROWS are below twice their share of the range.
        share = 2.0**64 * min(2.0 * SAMPLE_ROWS / rows, 1.0) - 2.0**63
        parts.append(ids.where((F.col("label") == label) & (F.col("_order") < share)))
    if not parts:
        return ids.select("label").limit(0), sizes
    least = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rank = F.row_number().over(Window.partitionBy("label").orderBy("_order"))
    # Twice SAMPLE_ROWS small rows.
    picked = settle(least.withColumn("_rank", rank).where(F.col("_rank") <= SAMPLE_ROWS), "quality-sample")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked.select("_id", "label", "_order")), "_id"
    )
    rows = rows.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.groupBy("label", "_key").agg(
        F.min("_order").alias("order"), F.min("text").alias("text")
    ).select("label", "order", "text"), sizes


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> QualityModel:
    """Vectors and output from labelled texts; ``usable`` is a condition on ``_id``.

    At most ``SAMPLE_ROWS`` documents of either label are learned from, those
    with the least hash of their id, whole texts, equal texts once. Labels other
    than 0 and 1 are left out; several labels of a document count as their
    maximum; a NULL text is empty. The descent weighs both labels alike; the
    offset, the log odds of label 1 among all usable labels, makes up for that.
    Where a label is missing, it alone decides the score.
    The descent runs in one task over the bounded sample; the driver receives
    the vectors, a fixed number.
    """
    bound_batches(docs.sparkSession)
    sample, sizes = _sample(docs, labels, id_col, text_col, label_col, usable)
    offset = float(np.log((sizes.get(1, 0) + 1) / (sizes.get(0, 0) + 1)))
    empty = QualityModel(np.zeros((BUCKETS, SIZE), np.float32), np.zeros((2, SIZE), np.float32), offset)
    if len(sizes) < 2:
        return empty

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(text_buckets(batch.column(2)))
            ids = pa.array([r[0].tobytes() for r in rows], pa.binary())
            shares = pa.array([r[1].tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], ids, shares], ["label", "order", "ids", "shares"])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for label, order, ids, shares in zip(*[c.to_pylist() for c in batch.columns]):
                rows.append((order, ids, label, shares))
        if len({row[2] for row in rows}) < 2:
            return
        rows.sort()
        texts = [(np.frombuffer(r[1], dtype=np.int32), np.frombuffer(r[3], dtype=np.float32)) for r in rows]
        vectors, output = descend(texts, np.array([r[2] for r in rows]))
        arrays = [pa.array([v.tobytes()], pa.binary()) for v in (vectors, output)]
        yield pa.RecordBatch.from_arrays(arrays, ["vectors", "output"])

    texts = settle(
        sample.mapInArrow(measured, "label int, order bigint, ids binary, shares binary"), "quality-buckets"
    )
    fitted = settle(texts.coalesce(1).mapInArrow(learned, "vectors binary, output binary"), "quality-model").collect()
    if not fitted:
        return empty
    vectors = np.frombuffer(bytes(fitted[0].vectors), dtype=np.float32).reshape(BUCKETS, SIZE)
    output = np.frombuffer(bytes(fitted[0].output), dtype=np.float32).reshape(2, SIZE)
    return QualityModel(vectors, output, offset)


def score_quality(
    docs: DataFrame, model: QualityModel, text_col: str = "text", into: str = "score"
) -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text; NULL is the empty text.

    An input column named like the result is replaced; repeated rows score
    alike; no rows give no rows. No shuffle: a text is judged in the task that
    reads it, by one number per bucket.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != into]
    given = docs.select(*kept)
    position = kept.index(text_col)
    schema = given.withColumn(into, F.lit(0.0)).schema
    # A fixed number of values, as a plain array.
    sent = docs.sparkSession.sparkContext.broadcast(model.margins())
    offset = model.offset

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = sent.value
        for batch in batches:
            margin = text_margins(batch.column(position), margins, offset)
            scores = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*kept, into])

    return given.mapInArrow(judge, schema)
