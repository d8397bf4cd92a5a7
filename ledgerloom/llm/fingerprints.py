"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.words import LOWER, mix, split_words, text_bytes

# Samples per fingerprint; the standard error of a likeness is at most 0.5 / sqrt(SAMPLES).
SAMPLES = 96
# Hex digits kept of a sample: unequal samples look equal once in 65,536.
DIGITS = 4
# Term hashes are cut to 48 bits, so that text and term fit one sort key.
TERM_BITS = 48
# Bytes of text sampled at once.
CHUNK = 1 << 19


def gamma_quantiles(bits: int) -> np.ndarray:
    """Gamma(2, 1) at the middles of 2 ** bits equal shares, from its distribution."""
    x = np.geomspace(1e-5, 60, 50_000)
    below = -np.expm1(-x) - x * np.exp(-x)
    return np.interp((np.arange(1 << bits) + 0.5) / (1 << bits), below, x)


class Sampler:
    """Per term and sample the two gamma draws and the offset, all from one hash.

    A term of weight S gets t = floor(ln S / r + b) and
    ln a = ln c - r (t - b) - r for r, c ~ Gamma(2, 1) and b ~ U(0, 1); the
    sample is the term with the least a, and its t.
    """

    R_BITS = 14
    C_BITS = 17
    BLOCK = 256  # terms at once, so that the arrays stay in a core's cache

    def __init__(self, samples: int = SAMPLES):
        self.seeds = mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.r = gamma_quantiles(self.R_BITS).astype(np.float32)
        self.log_c = np.log(gamma_quantiles(self.C_BITS)).astype(np.float32)

    def draws(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``r, b, ln c`` as arrays of terms by samples."""
        bits = terms[:, None] ^ self.seeds[None, :]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            bits ^= bits >> np.uint64(shift)
            bits *= np.uint64(factor)
        bits ^= bits >> np.uint64(31)
        low = bits.astype(np.uint32)
        b = (bits >> np.uint64(32)).astype(np.uint32).astype(np.float32) * np.float32(2.0**-32)
        r = self.r[low >> np.uint32(32 - self.R_BITS)]
        return r, b, self.log_c[low & np.uint32((1 << self.C_BITS) - 1)]

    def sample(self, weights: list[tuple[np.ndarray, np.ndarray]]) -> list[str]:
        """Fingerprints of ``(terms, weights)`` pairs; without terms all zeros."""
        every = np.concatenate([terms for terms, _ in weights]) if weights else np.zeros(0, np.uint64)
        known, place = np.unique(every, return_inverse=True)
        single = np.empty((len(known), len(self.seeds)), dtype=np.float32)  # ln a at weight 1: t is 0
        for at in range(0, len(known), self.BLOCK):
            r, b, log_c = self.draws(known[at : at + self.BLOCK])
            b -= np.float32(1)
            b *= r
            np.add(b, log_c, out=single[at : at + self.BLOCK])
        out, at = [], 0
        for terms, weight in weights:
            own = place[at : at + len(terms)]
            at += len(terms)
            out.append(self._one(terms, weight, single[own]))
        return out

    def _one(self, terms: np.ndarray, weight: np.ndarray, values: np.ndarray) -> str:
        samples = len(self.seeds)
        if not len(terms):
            return "0" * (DIGITS * samples)
        heavy = np.flatnonzero(weight > 1)
        step = np.zeros(samples, dtype=np.int64)
        if len(heavy):
            r, b, log_c = self.draws(terms[heavy])
            steps = np.floor(np.log(weight[heavy].astype(np.float32))[:, None] / r + b)
            values[heavy] = log_c - r * (steps - b) - r
        best = values.argmin(axis=0)
        if len(heavy):
            where = np.minimum(np.searchsorted(heavy, best), len(heavy) - 1)
            hit = np.flatnonzero(heavy[where] == best)
            step[hit] = steps[where[hit], hit]
        chosen = terms[best] * np.uint64(0x9E3779B97F4A7C15)
        marks = mix(chosen + step.astype(np.uint64)) % np.uint64(65535) + np.uint64(1)
        return marks.astype(">u2").tobytes().hex()


def weighted_terms(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct words, A-Z lower-cased, as hashes, and how often each occurs."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    words = split_words(LOWER[data], offsets)
    counts = words.counts()
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    keys = np.sort(doc << np.uint64(TERM_BITS) | words.hash >> np.uint64(64 - TERM_BITS))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(keys)))
    terms = keys[at]
    cuts = np.searchsorted(terms, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(TERM_BITS))
    terms = terms & np.uint64((1 << TERM_BITS) - 1)
    return [(terms[a:z], weight[a:z]) for a, z in zip(cuts[:-1], cuts[1:])]


def fingerprints(texts: list[str], sampler: Sampler | None = None) -> list[str]:
    sampler = sampler or Sampler()
    out: list[str] = []
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        # At most 60,000 texts share a sort: text numbers take the 16 bits beside a term.
        if size >= CHUNK or i + 1 == len(texts) or i - first >= 60_000:
            out += sampler.sample(weighted_terms(texts[first : i + 1]))
            first, size = i + 1, 0
    return out


def likeness(one: str, other: str) -> float:
    """Share of equal samples: estimates sum(min) / sum(max) of the term weights."""
    a = np.frombuffer(bytes.fromhex(one), dtype=">u2")
    b = np.frombuffer(bytes.fromhex(other), dtype=">u2")
    return float((a == b).mean()) if len(a) else 1.0


def fingerprint_texts(
    docs: DataFrame, text_col: str = "text", into: str = "fingerprint", samples: int = SAMPLES
) -> DataFrame:
    """``docs`` with the fingerprint of every whole text added; NULL is the empty text.

    All texts without words share one fingerprint, like each other fully and
    nothing else. An input column named like the result is replaced.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != into]
    given = docs.select(*kept)
    position = kept.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        for batch in batches:
            texts = [t or "" for t in batch.column(position).to_pylist()]
            marks = pa.array(fingerprints(texts, sampler), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], [*batch.schema.names, into])

    schema = given.withColumn(into, F.lit("")).schema
    return given.mapInArrow(add, schema)


def replace_tail(text: str, other: str) -> str:
    """The last third of the code points replaced by the first as many of ``other``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + other[:cut]


def _ranges(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, _range, _copy``: id ranges, each with a copy of the row that follows it.

    Rows go by descending id, NULL last. The copies, one per range, close the
    ranges, so every row meets its successor inside its range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("id"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    # At most one number per shuffle partition comes to the driver.
    cuts = ids.agg(F.percentile_approx("id", shares, 10 * parts)).first()[0] or []
    bounds = F.array(*[F.lit(v) for v in sorted(set(cuts))]).cast("array<bigint>")
    of = F.size(F.filter(bounds, lambda v: v < F.col("id")))
    tops = ids.groupBy(of.alias("range")).agg(F.max("id").alias("top")).orderBy("range").collect()
    after = [tops[i].range for i in range(1, len(tops))] + [tops[0].range if tops else 0]
    # One row per range.
    firsts = spark.createDataFrame(
        [(top.top, target) for top, target in zip(tops, after)], "_top bigint, _target int"
    )
    given = docs.select(
        F.col(id_col).alias("_given_id"),
        F.col(text_col).alias("_text"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("id"),
    ).withColumn("_range", of)
    marked = given.join(F.broadcast(firsts), F.col("id") == F.col("_top"), "left")
    own = F.struct(F.col("_range").alias("_range"), F.lit(False).alias("_copy"))
    copy = F.struct(F.col("_target").alias("_range"), F.lit(True).alias("_copy"))
    places = F.when(F.col("_target").isNull(), F.array(own)).otherwise(F.array(own, copy))
    # A range is a partition: dealt by hash, some would meet in one and leave others empty.
    return marked.select("id", "_given_id", "_text", F.inline(places)).repartitionById(
        parts, F.col("_range")
    ).sortWithinPartitions("_range", "_copy", F.desc("id"), F.col("_text").asc_nulls_first())


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sampler = Sampler()
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ]
    )
    held = None  # the row before: its successor is the next row of its range

    def results(rows: list[tuple]) -> pa.RecordBatch:
        edited = [replace_tail(row[1], after[1]) for row, after in zip(rows, rows[1:])]
        pairs = [i for i in range(len(rows) - 1) if rows[i][2] == rows[i + 1][2] and not rows[i][3]]
        texts = [row[1] for row in rows] + [edited[i] for i in pairs]
        marks = fingerprints(texts, sampler)
        out = []
        for j, i in enumerate(pairs):
            doc_id, text, _, _ = rows[i]
            own, changed = marks[i], marks[len(rows) + j]
            out.append(
                {
                    "doc_id": doc_id,
                    "n_chars": len(text),
                    "edited_sha256": hashlib.sha256(edited[i].encode()).hexdigest(),
                    "fingerprint": own,
                    "edited_fingerprint": changed,
                    "near_edited": likeness(own, changed),
                    "near_next": likeness(own, marks[i + 1]),
                }
            )
        return pa.RecordBatch.from_pylist(out, schema=schema)

    for batch in batches:
        size, rows = 0, [held] if held else []
        for value in zip(*[batch.column(i) for i in range(1, 5)]):
            doc_id, text, where, copy = (v.as_py() for v in value)
            rows.append((doc_id, text or "", where, copy))
            size += len(text or "")
            if size > 1 << 20:
                yield results(rows)
                size, rows = 0, rows[-1:]
        if len(rows) > 1:
            yield results(rows)
        held = rows[-1] if rows else held


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of every text and of the text with its last third replaced.

    The replacement is the start of the next text by descending id (after the
    last: the first). NULL texts are empty, NULL ids come last, rows with equal
    ids go by text, a lone row follows itself. Other columns are left out, no
    rows give no rows. Texts shuffle once, by id range; a range is sorted on
    disk if need be and read as a stream.
    """
    bound_batches(docs.sparkSession)
    return _ranges(docs, id_col, text_col).mapInArrow(_pairs, RESULT)
