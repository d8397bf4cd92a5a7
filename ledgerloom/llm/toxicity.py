"""Toxicity by a weighted grammar of clauses.

Small transducers read the word classes of a clause: one for insults, one for
threats, one each for targets, negation and reported speech. Composed, they are
one machine whose end state says what kind of clause it was. Documents are
scored by their matched clauses, not by the words alone; the weights of the
kinds of clauses and the stems of insults are learned from labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.sending import received, send
from ledgerloom.llm.words import (
    LOWER,
    Hasher,
    chunks,
    hash_bytes,
    split_words,
    text_bytes,
    window_hashes,
)
from ledgerloom.session import settle

# Words of the classes in the languages covered. Learned stems add to the insults.
INSULTS = (
    "idiot idiots moron morons scum trash loser losers stupid worthless pathetic clown clowns "
    "disgusting dumb trottel dummkopf abschaum imbécile crétin ordure idiota imbécil estúpido basura"
).split()
THREATS = (
    "kill hurt destroy beat smash crush punish töten schlagen vernichten tuer frapper détruire "
    "matar golpear destruir"
).split()
TARGETS = (
    "you your yours yourself he she they them him her people du dich dir ihr euch sie er tu toi "
    "vous il elle ils elles tú ti usted ustedes él ella ellos"
).split()
NEGATIONS = (
    "not no never none cannot don't isn't aren't nicht kein keine niemals ne pas jamais aucun nunca "
    "jamás ningún"
).split()
REPORTS = (
    "said says told claimed claims wrote quoted reported called sagte sagt schrieb behauptet dit "
    "disait écrit affirme dijo dice escribió afirma"
).split()

# Stems are the first 3 to 10 bytes of a word, or the whole word.
STEM_BYTES = range(3, 11)
WHOLE = 0x5851F42D4C957F2D
# Bound of the labelled rows of either label that are learned from.
SAMPLE_ROWS = 4000
# A stem has to occur in this many toxic documents, this share of them, and this
# many times as often there as in the others.
LEAST_DOCS = 3
LEAST_SHARE = 0.004
LEAST_RATIO = 12.0
# Bytes of text scored at once.
CHUNK = 1 << 19

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


class Transducer(NamedTuple):
    """States from 0; ``arcs[state][symbol]`` is the next state, ``marks[state]`` the output."""

    arcs: list[list[int]]
    marks: list[int]


def noticing(symbol: int, bit: int, before: tuple[int, ...] = ()) -> Transducer:
    """Marks ``bit`` once the symbol is read; with ``before``, only ahead of those symbols."""
    arcs = [[0] * 6, [1] * 6]
    arcs[0][symbol] = 1
    marks = [0, bit]
    if before:
        arcs.append([2] * 6)  # too late
        marks.append(0)
        for late in before:
            arcs[0][late] = 2
    return Transducer(arcs, marks)


def compose(machines: list[Transducer]) -> Transducer:
    """One machine that reads for all of them; its output joins theirs."""
    states = list(product(*[range(len(m.marks)) for m in machines]))
    number = {state: i for i, state in enumerate(states)}
    arcs = [
        [number[tuple(m.arcs[s][a] for m, s in zip(machines, state))] for a in range(6)]
        for state in states
    ]
    marks = [sum(m.marks[s] for m, s in zip(machines, state)) for state in states]
    return Transducer(arcs, marks)


INSULTED, THREATENED, TARGETED, NEGATED, REPORTED = 1, 2, 4, 8, 16
GRAMMAR = compose(
    [
        noticing(INSULT, INSULTED),
        noticing(THREAT, THREATENED),
        noticing(TARGET, TARGETED),
        noticing(NEGATION, NEGATED, before=(INSULT, THREAT)),
        noticing(REPORT, REPORTED, before=(INSULT, THREAT)),
    ]
)
KINDS = 32

# Weights of the kinds of clauses before anything is learned.
PRIOR = np.zeros(KINDS + 2)
for _kind in range(KINDS):
    if _kind & INSULTED or (_kind & THREATENED and _kind & TARGETED):
        PRIOR[_kind] = 3.0 + bool(_kind & TARGETED) - bool(_kind & NEGATED) - bool(_kind & REPORTED)
PRIOR[-1] = -2.0


class Lexicon(NamedTuple):
    """Hashes of insult stems and their log odds, sorted by hash."""

    hashes: np.ndarray
    odds: np.ndarray


def seeds() -> Lexicon:
    hashes = np.array([hash_bytes(w.encode()) for w in INSULTS], dtype=np.uint64) ^ np.uint64(WHOLE)
    return Lexicon(np.sort(hashes), np.full(len(hashes), 3.0))


class Texts(NamedTuple):
    """Words of consecutive texts without the punctuation at their ends."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    clause: np.ndarray
    hasher: Hasher


# What ends a clause, and what is no part of a word at its ends.
ENDS = np.zeros(256, dtype=bool)
ENDS[[ord(c) for c in ".!?;:,"]] = True
EDGES = np.zeros(256, dtype=bool)
EDGES[[ord(c) for c in "!\"#&'()*,-.:;<=>?@[\\]^_`{|}~$%+/"]] = True


def read_texts(data: np.ndarray, offsets: np.ndarray) -> Texts:
    data = LOWER[data]
    hasher = Hasher(data)
    words = split_words(data, offsets, hasher)
    start, end = words.start, words.end
    count = len(start)
    breaks = np.zeros(count, dtype=bool)
    if count:
        breaks[1:] = ENDS[data[words.end[:-1] - 1]]
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        breaks[1:] |= lines[words.start[1:]] != lines[words.end[:-1]]
        opens = words.first[:-1]
        breaks[opens[opens < count]] = True
        # The next and the last byte that is no punctuation, seen from each byte.
        place = np.arange(len(data))
        inner = ~EDGES[data]
        after = np.minimum.accumulate(np.where(inner, place, len(data))[::-1])[::-1]
        ahead = np.maximum.accumulate(np.where(inner, place, -1))
        start = np.minimum(after[words.start], words.end)
        end = np.maximum(ahead[words.end - 1] + 1, start)
    return Texts(words.first, start, end, np.cumsum(breaks), hasher)


def stem_hashes(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``words, hashes`` for each stem length, whole words last."""
    length = texts.end - texts.start
    for size in STEM_BYTES:
        words = np.flatnonzero(length > size)
        yield words, texts.hasher.of(texts.start[words], texts.start[words] + size)
    words = np.flatnonzero(length > 0)
    whole = texts.hasher.of(texts.start[words], texts.end[words])
    yield words, whole ^ np.uint64(WHOLE)


def _lookup(hashes: np.ndarray) -> np.ndarray:
    low = np.zeros(1 << 16, dtype=bool)
    low[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
    return low


def document_features(texts: Texts, lexicon: Lexicon, classes: dict[int, np.ndarray]) -> np.ndarray:
    """Per text the logged count of each kind of matched clause, the best odds, and 1."""
    n = len(texts.first) - 1
    out = np.zeros((n, KINDS + 2))
    out[:, -1] = 1
    symbols = np.zeros(len(texts.start), dtype=np.int8)
    odds = np.zeros(len(texts.start))
    low = _lookup(lexicon.hashes)
    for words, hashes in stem_hashes(texts):
        maybe = np.flatnonzero(low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(lexicon.hashes, hashes[maybe]), len(lexicon.hashes) - 1)
        hit = lexicon.hashes[at] == hashes[maybe]
        found = words[maybe[hit]]
        symbols[found] = INSULT
        odds[found] = np.maximum(odds[found], lexicon.odds[at[hit]])
    whole = hashes
    for symbol, known in classes.items():
        hit = words[np.isin(whole, known)]
        symbols[hit[symbols[hit] == OTHER]] = symbol
    matched = np.unique(texts.clause[(symbols == INSULT) | (symbols == THREAT)])
    if len(matched):
        begin = np.searchsorted(texts.clause, matched, side="left")
        finish = np.searchsorted(texts.clause, matched, side="right")
        owner = np.searchsorted(texts.first, begin, side="right") - 1
        for a, z, doc in zip(begin, finish, owner):
            state = 0
            for symbol in symbols[a:z]:
                state = GRAMMAR.arcs[state][symbol]
            kind = GRAMMAR.marks[state]
            out[doc, kind] += 1
            out[doc, KINDS] = max(out[doc, KINDS], odds[a:z].max())
    out[:, :KINDS] = np.log1p(out[:, :KINDS])
    return out


def word_classes() -> dict[int, np.ndarray]:
    named = {THREAT: THREATS, TARGET: TARGETS, NEGATION: NEGATIONS, REPORT: REPORTS}
    return {
        symbol: np.array([hash_bytes(w.encode()) for w in words], dtype=np.uint64) ^ np.uint64(WHOLE)
        for symbol, words in named.items()
    }


def features_of(column: pa.Array, lexicon: Lexicon, classes: dict[int, np.ndarray]) -> np.ndarray:
    data, offsets = text_bytes(column)
    parts = [
        document_features(
            read_texts(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]), lexicon, classes
        )
        for a, z in chunks(offsets, CHUNK)
    ]
    return np.concatenate(parts) if parts else np.zeros((0, KINDS + 2))


def fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the prior weights."""
    weights = PRIOR.copy()
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (chance - y) + 0.1 * (weights - PRIOR)
        bend = (x * (chance * (1 - chance))[:, None]).T @ x + 0.1 * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights = weights - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column) -> DataFrame:
    """At most ``SAMPLE_ROWS`` labelled texts of either label, near copies of a text once.

    Copies share the least hash of their five-word windows, of which one is kept.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")
    ).agg(F.max(label_col).cast("int").alias("toxic"))
    ids = settle(known.where(usable).withColumn("_order", F.xxhash64("_id")), "labels")
    sizes = ids.groupBy("toxic").agg(F.count("*").alias("_rows"))  # two rows
    # Hashes are even: the least SAMPLE_ROWS of a label are below twice their share
    # of the range, which leaves few rows of a label for one task to rank.
    share = F.lit(2.0**64) * F.least(F.lit(2.0 * SAMPLE_ROWS) / F.col("_rows"), F.lit(1.0))
    ids = ids.join(F.broadcast(sizes), "toxic").where(F.col("_order") < share - F.lit(2.0**63)).drop("_rows")
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy("_order"))
    # Twice SAMPLE_ROWS small rows.
    ids = settle(ids.withColumn("_rank", rank).where(F.col("_rank") <= SAMPLE_ROWS), "label-sample")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids.select("_id", "toxic")), "_id"
    ).select("text", "toxic")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            marks = []
            for text in range(len(offsets) - 1):
                part = LOWER[data[offsets[text] : offsets[text + 1]]]
                words = split_words(part, np.array([0, len(part)]))
                windows = window_hashes(words.hash, min(5, max(len(words.hash), 1)))
                marks.append(int(windows.min() >> np.uint64(1)) if len(windows) else -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], ["text", "toxic", "sketch"])

    marked = rows.mapInArrow(sketch, "text string, toxic int, sketch bigint")
    once = marked.groupBy("toxic", "sketch").agg(F.min("text").alias("text"))
    return settle(once.select("text", "toxic"), "toxicity-sample")


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other documents per stem, of ``text, toxic``."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, z in chunks(offsets, CHUNK):
            texts = read_texts(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a])
            owner = np.repeat(np.arange(z - a, dtype=np.uint64), np.diff(texts.first))
            pairs = np.concatenate(
                [np.stack([hashes, owner[words]], axis=1) for words, hashes in stem_hashes(texts)]
            )
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            new = np.ones(len(pairs), dtype=bool)
            new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
            stems, of = np.unique(pairs[new, 0], return_inverse=True)
            label = toxic[a:z][pairs[new, 1].astype(np.int64)]
            counts = [np.bincount(of[label == side], minlength=len(stems)) for side in (1, 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(stems.view(np.int64)), *map(pa.array, counts)], ["stem", "inside", "outside"]
            )


class ToxicityModel(NamedTuple):
    lexicon: Lexicon
    weights: np.ndarray


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Stems and weights from labelled texts; ``usable`` is a condition on ``_id``.

    Labels other than 0 and 1 are left out, several labels of a document count
    as their maximum. Without texts of both labels the listed words and prior
    weights stay. At most twice ``SAMPLE_ROWS`` texts are read for it.
    Stems are counted and picked by Spark; those that tell toxic texts from
    others, which the sample bounds, and one feature row per sampled text come to
    the driver.
    """
    bound_batches(docs.sparkSession)
    sample = _sample(docs, labels, id_col, text_col, label_col, usable)
    sizes = {row.toxic: row["count"] for row in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel(seeds(), PRIOR)
    least = max(LEAST_DOCS, LEAST_SHARE * sizes[1])
    counts = sample.select("text", "toxic").mapInArrow(_stem_counts, "stem bigint, inside bigint, outside bigint")
    counts = counts.groupBy("stem").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    ratio = ((F.col("inside") + 0.5) / (sizes[1] + 1)) / ((F.col("outside") + 0.5) / (sizes[0] + 1))
    telling = counts.where(F.col("inside") >= least).select("stem", ratio.alias("ratio"))
    found = telling.where(F.col("ratio") >= LEAST_RATIO).orderBy("stem").toArrow()
    stems = found.column("stem").to_numpy().view(np.uint64)
    base = seeds()
    odds = dict(zip(base.hashes.tolist(), base.odds.tolist()))
    odds.update(zip(stems.tolist(), np.log(found.column("ratio").to_numpy()).tolist()))
    hashes = np.array(sorted(odds), dtype=np.uint64)
    lexicon = Lexicon(hashes, np.array([odds[int(h)] for h in hashes]))
    classes = word_classes()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features_of(batch.column(0), lexicon, classes)
            rows = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([rows, batch.column(1)], ["x", "toxic"])

    found = sample.mapInArrow(measured, "x binary, toxic int").orderBy("x", "toxic").collect()
    x = np.stack([np.frombuffer(bytes(row.x)) for row in found])
    return ToxicityModel(lexicon, fit_weights(x, np.array([row.toxic for row in found], dtype=float)))


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", into: str = "score"
) -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text; NULL is the empty text.

    An input column named like the result is replaced. No shuffle.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != into]
    given = docs.select(*kept)
    position = kept.index(text_col)
    schema = given.withColumn(into, F.lit(0.0)).schema
    sent = send(docs.sparkSession.sparkContext, model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = received(sent)
        classes = word_classes()
        for batch in batches:
            x = features_of(batch.column(position), lexicon, classes)
            scores = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*kept, into])

    return given.mapInArrow(judge, schema)
