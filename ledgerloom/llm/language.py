"""Language by family first, then one-versus-one linear machines within the family."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.sending import received, send
from ledgerloom.session import settle

# Families of languages. A language without one is its own family.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "rm", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "celtic": ["br", "cy", "ga", "gd", "gv", "kw"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "tk", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "sinitic": ["yue", "zh"],
}
FAMILY_OF = {lang: family for family, members in FAMILIES.items() for lang in members}

UNKNOWN = "und"
# Hashed counts of 1, 2 and 3 neighbouring letters.
FEATURES = 1 << 12
# Bound of the sample the machines are fitted on, shared out over the languages.
SAMPLE_ROWS = 2400
EPOCHS = 12
REGULAR = 1e-4
# Margin to probability.
SLOPE = 4.0


def letter_table() -> np.ndarray:
    """Code points of the first plane; whatever is no letter becomes a space."""
    table = np.arange(1 << 16, dtype=np.uint32)
    table[[i for i in range(1 << 16) if not chr(i).isalpha()]] = 32
    return table


def features(text: str, table: np.ndarray) -> np.ndarray:
    """Square roots of hashed n-gram counts, scaled to length 1; of the whole text."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    if (points >= 1 << 16).any():
        letters = points.copy()
        low = points < 1 << 16
        letters[low] = table[points[low]]
    else:
        letters = table[points]
    one = letters * np.uint32(2654435761)
    two = one[:-1] * np.uint32(31) + letters[1:] * np.uint32(40503)
    three = two[:-1] * np.uint32(17) + letters[2:] * np.uint32(2246822519)
    counts = np.zeros(FEATURES)
    for grams in (one, two, three):
        grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        counts += np.bincount(grams >> np.uint32(20), minlength=FEATURES)
    counts = np.sqrt(counts).astype(np.float32)
    length = np.linalg.norm(counts)
    return counts / length if length else counts


def linear_machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine, by averaged subgradients."""
    weights = np.zeros(x.shape[1] + 1)
    total = np.zeros_like(weights)
    wide = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1)) * len(y)
    order = np.random.default_rng(7)
    step = 0
    for _ in range(EPOCHS):
        for i in order.permutation(len(y)):
            step += 1
            rate = 1.0 / (REGULAR * (step + 1 / REGULAR))
            weights *= 1 - rate * REGULAR
            if y[i] * (wide[i] @ weights) < 1:
                weights += rate * share[i] * y[i] * wide[i]
            total += weights
    mean = total / max(step, 1)
    return mean[:-1].astype(np.float32), float(mean[-1])


class LanguageModel:
    """Family machines, and machines for each pair of languages of a family."""

    def __init__(self, langs: list[str], x: np.ndarray):
        self.langs = sorted(set(langs))
        family = {lang: FAMILY_OF.get(lang.split("-")[0].lower(), lang) for lang in self.langs}
        self.members: dict[str, list[str]] = {}
        for lang in self.langs:
            self.members.setdefault(family[lang], []).append(lang)
        self.families = sorted(self.members)
        given = np.array(langs)
        of = np.array([family[lang] for lang in langs])
        self.family_machines = [
            linear_machine(x, np.where(of == name, 1, -1)) for name in self.families
        ] if len(self.families) > 1 else []
        self.pairs = [
            pair for name in self.families for pair in combinations(self.members[name], 2)
        ]
        self.machines = []
        for one, other in self.pairs:
            rows = (given == one) | (given == other)
            self.machines.append(linear_machine(x[rows], np.where(given[rows] == one, 1, -1)))
        every = [*self.family_machines, *self.machines]
        self.weights = np.stack([w for w, _ in every], axis=1) if every else np.zeros((FEATURES, 0))
        self.bias = np.array([b for _, b in every])

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ self.weights + self.bias
        count = len(self.family_machines)
        n = len(x)
        if count:
            shares = 1 / (1 + np.exp(-SLOPE * margins[:, :count]))
            family = margins[:, :count].argmax(axis=1)
            sure = shares[np.arange(n), family] / shares.sum(axis=1)
        else:
            family, sure = np.zeros(n, dtype=int), np.ones(n)
        place = {pair: count + i for i, pair in enumerate(self.pairs)}
        langs = np.empty(n, dtype=object)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            members = self.members[name]
            votes = np.zeros((len(rows), len(members)))
            for i, j in combinations(range(len(members)), 2):
                chance = 1 / (1 + np.exp(-SLOPE * margins[rows, place[members[i], members[j]]]))
                # A won duel is a vote; the chances break ties between votes.
                votes[:, i] += (chance >= 0.5) + chance / len(members)
                votes[:, j] += (chance < 0.5) + (1 - chance) / len(members)
            best = votes.argmax(axis=1)
            langs[rows] = np.array(members, dtype=object)[best]
            if len(members) > 1:
                most = len(members) - 1
                sure[rows] *= np.clip(votes[np.arange(len(rows)), best] / (most + most / len(members)), 0, 1)
        return list(langs), sure


def fit_languages(docs: DataFrame, text_col: str, lang_col: str, key: Column, usable: Column) -> LanguageModel | None:
    """A model from at most ``SAMPLE_ROWS`` usable rows; None without any.

    Of every language the rows with the least ``key`` are taken, and fitted on in
    one task. What comes to the driver is the model.
    """
    bound_batches(docs.sparkSession)
    rows = docs.where(usable & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("_lang"), F.xxhash64(key).alias("_order")
    )
    sizes = settle(rows.groupBy("_lang").agg(F.count("*").alias("_rows")), "language-sizes")
    langs = sizes.count()
    if not langs:
        return None
    each = max(SAMPLE_ROWS // langs, 1)
    # Hashes are even: the least `each` of a language are below twice their share
    # of the range, which leaves few rows of a language for one task to rank.
    share = F.lit(2.0**64) * F.least(F.lit(2.0 * each + 16) / F.col("_rows"), F.lit(1.0))
    least = rows.join(F.broadcast(sizes), "_lang").where(F.col("_order") < share - F.lit(2.0**63))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_order"))
    picked = least.withColumn("_rank", rank).where(F.col("_rank") <= each)
    # `each` rows per language at most.
    limits = picked.groupBy("_lang").agg(F.max("_order").alias("_most"))
    sample = docs.where(usable).select(
        F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"), F.xxhash64(key).alias("_order")
    ).join(F.broadcast(limits), "_lang").where(F.col("_order") <= F.col("_most"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = [features(t, table).astype(np.float16).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["lang", "x"])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, rows = [], []
        for batch in batches:
            given += batch.column(0).to_pylist()
            rows += [np.frombuffer(x, dtype=np.float16) for x in batch.column(1).to_pylist()]
        parts = vars(LanguageModel(given, np.stack(rows).astype(np.float32)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(parts)], pa.binary())], ["model"])

    found = (
        sample.select("_lang", "_text").mapInArrow(measured, "lang string, x binary")
        .orderBy("lang", "x").limit(2 * SAMPLE_ROWS + langs).mapInArrow(learned, "model binary")
    )
    model = LanguageModel.__new__(LanguageModel)
    vars(model).update(pickle.loads(settle(found, "language-model").first().model))
    return model


def identify_languages(
    docs: DataFrame,
    model: LanguageModel | None,
    text_col: str = "text",
    into: str = "lang_pred",
    score_into: str = "score",
) -> DataFrame:
    """``docs`` with a language and a score from 0 to 1 for every whole text.

    NULL texts, texts without a letter, and all texts where there was nothing
    to learn from get ``und`` and 0. Input columns named like the added ones are
    replaced. No shuffle: a text is judged in the task that reads it.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (into, score_into)]
    given = docs.select(*kept)
    position = kept.index(text_col)
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    schema = given.withColumns({into: F.lit(""), score_into: F.lit(0.0)}).schema
    sent = send(docs.sparkSession.sparkContext, model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table()
        model = received(sent)
        for batch in batches:
            flags = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            column = batch.column(position)
            langs = [UNKNOWN] * len(flags)
            scores = np.zeros(len(flags))
            rows = np.flatnonzero(flags) if model else np.zeros(0, dtype=int)
            for at in range(0, len(rows), 256):
                part = rows[at : at + 256]
                x = np.stack([features(column[int(i)].as_py(), table) for i in part])
                found, sure = model.predict(x)
                scores[part] = sure
                for i, lang in zip(part, found):
                    langs[i] = lang
            arrays = [*batch.columns[: len(kept)], pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, into, score_into])

    return given.withColumn("_lettered", lettered).mapInArrow(judge, schema)
