"""Near copies: all documents whose word shingles have a Jaccard similarity above a bound."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.packed import SCHEMA, by_bucket, pack, split_by, to_batch
from ledgerloom.llm.words import Words, mix, window_hashes, word_chunks
from ledgerloom.llm.sending import received, send
from ledgerloom.session import settle

# Words per shingle, and the similarity as a share: linked when 4 * common >= 3 * all.
SHINGLE = 5
NUM, DEN = 3, 4
# Sizes per band grow by this factor; a band's universe has this many segments per
# token of its smallest set. More segments hold fewer tokens each.
BAND_RATIO = 4
SEGMENTS = 3
# Steps to finer segments, tried where a set has too few segments with tokens.
LADDER = 12

# Tokens a cost is kept for, the most frequent first; those seen SEEN times or more
# of COUNTED tokens in a task are counted. Costs decide which signatures are
# used, never which pairs are found.
COSTS = 1 << 18
COUNTED = 1 << 22
SEEN = 2
# Signatures that are dealt to the buckets at once.
PACKED = 1 << 20
# Signatures per bucket, and rows of ids up to which a list is sent to all tasks.
BUCKET_ROWS = 1 << 19
SENT_IDS = 1 << 18
# Pairs of one document that one task compares, and members of a group compared at once.
FAN = 256
BLOCK = 1024
# An id that sorts behind all others stands in for NULL.
NO_ID = (1 << 63) - 1


def shingle_sets(words: Words, width: int = SHINGLE) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles.

    A text with fewer words is one shingle, one without words has none.
    """
    hashes = window_hashes(words.hash, width)
    out = []
    for a, z in zip(words.first[:-1], words.first[1:]):
        if z - a >= width:
            out.append(np.unique(hashes[a : z - width + 1]))
        elif z > a:
            out.append(window_hashes(words.hash[a:z], z - a) + np.uint64(z - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def band_of(size: int) -> int:
    """Band 0 holds sizes 1 to 3, band 1 sizes 4 to 15, and so on."""
    return (size.bit_length() - 1) // 2


def levels_of(size: int) -> list[tuple[int, int]]:
    """``(level, most differences)``: where a set of this size meets its partners.

    A pair meets on the level of the band of its smaller set. Linked sets of
    sizes s and t differ in at most (s + t) / 7 tokens.
    """
    own = band_of(size)
    # As the smaller one: the partner has at most size * DEN / NUM tokens.
    out = [(own, (size + size * DEN // NUM) * (DEN - NUM) // (DEN + NUM))]
    low = BAND_RATIO**own
    if own and -(-size * NUM // DEN) < low:
        out.append((own - 1, (size + low - 1) * (DEN - NUM) // (DEN + NUM)))
    return out


class Plan(NamedTuple):
    """How tokens are dealt to segments, and what tokens cost."""

    steps: dict[int, int]  # of a level: how much finer its segments are
    frequent: np.ndarray  # sorted hashes of frequent tokens
    cost: np.ndarray  # log2 of how many documents hold them


def segment_count(level: int, step: int) -> int:
    return SEGMENTS * BAND_RATIO**level << (2 * step)


def segments_of(tokens: np.ndarray, level: int, step: int) -> np.ndarray:
    """Segment of each token; on the last step each token is its own."""
    if step >= LADDER:
        return tokens
    seed = np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
    return mix(tokens ^ seed) % np.uint64(segment_count(level, step))


def step_needed(tokens: np.ndarray, level: int, most: int) -> int:
    """The first step on which more segments hold tokens than may differ."""
    step = 0
    while step < LADDER and len(np.unique(segments_of(tokens, level, step))) <= most:
        step += 1
    return step


def signatures(tokens: np.ndarray, plan: Plan) -> np.ndarray:
    """Hashes of which two linked sets share at least one.

    Level 0: the set and, where one token may differ, the set without each of
    its tokens. Above: of the segments with tokens the ``most + 1`` cheapest in
    one order for all sets, a segment costing what its rarest token does. Linked
    sets agree on all but ``most`` of their segments, so the first common
    segment in that order is among the first ``most + 1`` of both.
    """
    out = []
    size = len(tokens)
    at = np.minimum(np.searchsorted(plan.frequent, tokens), max(len(plan.frequent) - 1, 0))
    token_cost = np.zeros(size, dtype=np.int64)
    if len(plan.frequent):
        known = plan.frequent[at] == tokens
        token_cost[known] = plan.cost[at[known]]
    for level, most in levels_of(size):
        salt = np.uint64(0xD1B54A32D192ED03 * (2 * level + 1) & 0xFFFFFFFFFFFFFFFF)
        if level == 0:
            whole = mixed_sum(tokens)
            out.append(mix(np.array([whole], dtype=np.uint64) ^ salt))
            if most:
                out.append(mix((whole - mix(tokens)) ^ salt))
            continue
        segment = segments_of(tokens, level, plan.steps.get(level, 0))
        order = np.argsort(segment, kind="stable")
        sorted_segment = segment[order]
        begins = np.flatnonzero(np.concatenate([[True], sorted_segment[1:] != sorted_segment[:-1]]))
        sums = np.add.reduceat(mix(tokens[order]), begins)
        cost = np.minimum.reduceat(token_cost[order], begins)
        marks = mix(sums ^ mix(sorted_segment[begins]) ^ salt)
        if len(marks) > most + 1:
            marks = marks[np.lexsort((marks, cost))[: most + 1]]
        out.append(marks)
    return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=np.uint64)


def mixed_sum(tokens: np.ndarray) -> np.uint64:
    return np.add.reduce(mix(tokens))


DOC, TOKEN, STEP = range(3)
FACTS = "kind int, id bigint, a bigint, b bigint, n bigint, bits binary"
SKETCH = "id bigint, n bigint, bits binary"


def parities(tokens: np.ndarray) -> bytes:
    """One bit per bucket of tokens, over twice as many as tokens: is their number odd?

    Sets that differ in d tokens differ in at most d bits, whatever the tokens.
    """
    buckets = 2 << max(6, len(tokens).bit_length())
    at = (mix(tokens ^ np.uint64(0x8CB92BA72F3D8DD7)) & np.uint64(buckets - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=buckets) & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Parities of fewer buckets: each is the sum of every ``words``-th 64 of them."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def may_link(n: np.ndarray, bits: np.ndarray, size: int, own: np.ndarray) -> np.ndarray:
    """Which sets, of sizes ``n`` and with parities ``bits`` in rows, may be linked to one."""
    total = n + size
    near = np.minimum(n, size) * DEN >= np.maximum(n, size) * NUM
    differ = np.bitwise_count(bits ^ own[None, :]).sum(axis=1, dtype=np.int64)
    return near & (differ * (DEN + NUM) <= total * (DEN - NUM))


def _set_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    one = np.add.reduce(mix(tokens ^ np.uint64(0xA24BAED4963EE407)))
    two = np.add.reduce(mix(tokens ^ np.uint64(0x9FB21C651E98DF25)))
    return tuple(np.array([one, two], dtype=np.uint64).view(np.int64).tolist())


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    for first, _, _, _, words in word_chunks(batch.column(1), True):
        yield first, shingle_sets(words)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its set's key, size and parities; frequent tokens; per level the step needed."""

    def rows(kind: int, *columns, bits: list[bytes] | None = None) -> pa.RecordBatch:
        size = len(columns[0])
        given = [pa.array(np.asarray(c, dtype=np.int64)) for c in columns]
        given += [pa.nulls(size, pa.int64())] * (4 - len(given))
        given.append(pa.nulls(size, pa.binary()) if bits is None else pa.array(bits, pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, kind, dtype=np.int32)), *given], ["kind", "id", "a", "b", "n", "bits"]
        )

    def counted(tokens: list[np.ndarray]) -> pa.RecordBatch:
        every = np.sort(np.concatenate(tokens)) if tokens else np.zeros(0, np.uint64)
        new = np.ones(len(every), dtype=bool)
        new[1:] = every[1:] != every[:-1]
        begins = np.flatnonzero(new)
        times = np.diff(np.append(begins, len(every)))
        often = times >= SEEN
        return rows(TOKEN, every[begins[often]].view(np.int64), times[often])

    steps: dict[int, int] = {}
    tokens: list[np.ndarray] = []
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        keys, sizes, marks = [], [], []
        for _, sets in _sets(batch):
            for found in sets:
                keys.append(_set_key(found))
                sizes.append(len(found))
                tokens.append(found)
                marks.append(parities(found))
                for level, most in levels_of(len(found)) if len(found) else []:
                    if level:
                        needed = step_needed(found, level, most)
                        steps[level] = max(steps.get(level, 0), needed)
        yield rows(DOC, ids, [k[0] for k in keys], [k[1] for k in keys], sizes, bits=marks)
        if sum(map(len, tokens)) >= COUNTED:
            yield counted(tokens)
            tokens = []
    yield counted(tokens)
    if steps:
        yield rows(STEP, list(steps), list(steps.values()))


def _token_costs(facts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, at most `COSTS`, sorted, and log2 of their counts."""
    counts = facts.where(F.col("kind") == TOKEN).groupBy("id").agg(F.sum("a").alias("n"))
    costs = counts.select("id", F.floor(F.log2("n")).cast("int").alias("cost"))
    costs = settle(costs, "token-costs")
    least, taken = 64, 0
    for row in costs.groupBy("cost").count().orderBy(F.desc("cost")).collect():  # 64 rows at most
        taken += row["count"]
        if taken > COSTS:
            break
        least = row.cost
    found = costs.where(F.col("cost") >= least).toArrow()
    frequent = found.column("id").to_numpy().view(np.uint64)
    order = np.argsort(frequent)
    return frequent[order], found.column("cost").to_numpy().astype(np.int64)[order]


def _signature_rows(sent, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = received(sent)
        seen: dict[tuple[int, int], int] = {}
        marks: list[np.ndarray] = []
        owners: list[int] = []
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, sets in _sets(batch):
                for i, tokens in enumerate(sets):
                    if not len(tokens):
                        continue
                    key, own = _set_key(tokens), int(ids[first + i])
                    # Equal sets met so far are one row under the smallest id; their
                    # ids are joined by the key of the set.
                    if key in seen:
                        place = seen[key]
                        owners[place] = min(owners[place], own)
                    else:
                        seen[key] = len(marks)
                        marks.append(signatures(tokens, plan))
                        owners.append(own)
            if sum(map(len, marks)) >= PACKED:
                yield from dealt(marks, owners)
                seen, marks, owners = {}, [], []
        if marks:
            yield from dealt(marks, owners)

    def dealt(marks: list[np.ndarray], owners: list[int]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate(marks)
        place = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
        bucket = (every >> np.uint64(32)).astype(np.int64) * buckets >> 32
        own = np.array(owners, dtype=np.int64)
        rows = []
        for key, picked in split_by(bucket):
            used, at = np.unique(place[picked], return_inverse=True)
            at = at.astype(np.uint16 if len(used) < 1 << 16 else np.uint32)
            rows.append((key, pack([every[picked], own[used], at])))
            if len(rows) >= 256:
                yield to_batch(rows)
                rows = []
        if rows:
            yield to_batch(rows)

    return run


def _shared_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``sig, id`` of the signatures that several ids have."""
    for _, parts in by_bucket(batches):
        marks = np.concatenate([p[0] for p in parts])
        ids = np.concatenate([p[1][p[2]] for p in parts])
        order = np.lexsort((ids, marks))
        marks, ids = marks[order], ids[order]
        new = np.ones(len(marks), dtype=bool)
        new[1:] = (marks[1:] != marks[:-1]) | (ids[1:] != ids[:-1])
        marks, ids = marks[new], ids[new]
        shared = np.zeros(len(marks), dtype=bool)
        same = marks[1:] == marks[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        yield pa.RecordBatch.from_arrays(
            [pa.array(marks[shared].view(np.int64)), pa.array(ids[shared])], ["sig", "id"]
        )


def linked(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether sorted sets have a similarity of ``NUM / DEN`` or more."""
    small, large = (one, other) if len(one) <= len(other) else (other, one)
    if not len(small) or len(small) * DEN < len(large) * NUM:
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return DEN * common >= NUM * (len(small) + len(large) - common)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Linked pairs; the texts of a pair's first id come before those of its partners."""
    key, leaders = None, []
    for batch in batches:
        one, part, other = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        found: list[tuple[int, int]] = []
        for first, _, _, _, words in word_chunks(batch.column(3), True):
            for i, tokens in enumerate(shingle_sets(words), first):
                if (one[i], part[i]) != key:
                    key, leaders = (one[i], part[i]), []
                if other[i] < 0:
                    leaders.append(tokens)
                elif any(linked(leader, tokens) for leader in leaders):
                    found.append((int(one[i]), int(batch.column(4)[i].as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())],
            ["u", "v"],
        )


def _closer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with the sizes and parities of both, those that may be linked."""
    for batch in batches:
        u, v, n, m = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        kept = np.zeros(len(u), dtype=bool)
        for i, (one, other) in enumerate(zip(batch.column(4), batch.column(5))):
            one = np.frombuffer(one.as_py(), dtype=np.uint64)
            other = np.frombuffer(other.as_py(), dtype=np.uint64)
            words = min(len(one), len(other))
            kept[i] = may_link(m[i : i + 1], fold(other, words)[None, :], n[i], fold(one, words))[0]
        yield pa.RecordBatch.from_arrays([pa.array(u[kept]), pa.array(v[kept])], ["u", "v"])


def closer_pairs(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of the pairs ``u, v`` whose sizes and parities do not rule a link out."""
    one = sketches.select(F.col("id").alias("u"), "n", "bits")
    other = sketches.select(F.col("id").alias("v"), F.col("n").alias("m"), F.col("bits").alias("marks"))
    both = pairs.join(one, "u").join(other, "v").select("u", "v", "n", "m", "bits", "marks")
    return both.mapInArrow(_closer, "u bigint, v bigint").distinct()


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each unit; they have to come sorted by unit, their first column."""
    unit, rows = None, []
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            if row[0] != unit and rows:
                yield rows
                rows = []
            unit = row[0]
            rows.append(row)
    if rows:
        yield rows


def _open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a unit that may be linked to one with another label, by sizes and parities."""
    for rows in _by_unit(batches):
        labels = np.array([r[2] for r in rows])
        n = np.array([r[3] for r in rows])
        whole = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
        lengths = np.array([len(w) for w in whole])
        open_ones = np.zeros(len(rows), dtype=bool)
        # Linked sets differ by a third in size at most, so by one step in resolution.
        for words in np.unique(lengths).tolist():
            near = np.flatnonzero((lengths == words) | (lengths == 2 * words))
            near = near[np.argsort(lengths[near], kind="stable")]
            bits = np.stack([fold(whole[i], words) for i in near])
            for at in range(int((lengths[near] == words).sum())):
                i, rest = near[at], near[at + 1 :]
                other = labels[rest] != labels[i]
                if other.any():
                    hit = rest[other & may_link(n[rest], bits[at + 1 :], n[i], bits[at])]
                    open_ones[hit] = True
                    open_ones[i] |= bool(len(hit))
        # An id with several sets comes once; all its texts follow it.
        kept = {rows[i][1]: rows[i][:3] for i in np.flatnonzero(open_ones)}
        arrays = [pa.array([row[c] for row in kept.values()], pa.int64()) for c in range(3)]
        yield pa.RecordBatch.from_arrays(arrays, ["unit", "id", "label"])


def _join_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``u, v``: labels of a unit's members that links join, one link fewer than labels at most."""
    for rows in _by_unit(batches):
        sets: list[np.ndarray] = []
        for _, _, _, _, words in word_chunks(pa.array([r[3] for r in rows], pa.string()), True):
            sets += shingle_sets(words)
        labels = np.array([r[2] for r in rows])
        sizes = np.array([len(s) for s in sets])
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        begins = np.cumsum(sizes) - sizes
        held = np.zeros(int(token.max(initial=-1)) + 1, dtype=bool)
        u, v = [], []
        for i in np.flatnonzero(sizes):
            if (labels[i + 1 :] == labels[i]).all():
                continue
            own = token[begins[i] : begins[i] + sizes[i]]
            held[own] = True
            common = np.bincount(owner, weights=held[token], minlength=len(sets)).astype(np.int64)
            held[own] = False
            link = (DEN * common >= NUM * (sizes + sizes[i] - common)) & (sizes > 0) & (labels != labels[i])
            for label in np.unique(labels[link]).tolist():
                u.append(min(label, int(labels[i])))
                v.append(max(label, int(labels[i])))
                # From here on both are one; linked or not, they need no more looking at.
                labels[labels == label] = labels[i]
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def verify_pairs(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs ``u, v`` whose shingle sets are linked, as ``u, v``.

    ``texts`` has ``_id`` and ``_text``. The partners of an id are dealt out in
    parts of about `FAN`, each with a copy of the id's own text, so that an id
    with very many partners is no single task. A short list of ids is sent to
    the texts; beyond `SENT_IDS` the texts are shuffled to it, once.
    """
    counts = pairs.groupBy(F.col("u").alias("_u")).agg(
        F.ceil(F.count("*") / F.lit(FAN)).cast("bigint").alias("_parts")
    )
    counts = settle(counts, "pair-counts")
    partners = pairs.join(counts, pairs["u"] == counts["_u"]).select(
        F.col("v").alias("_key"), "u", F.pmod(F.xxhash64("v"), F.col("_parts")).alias("part"),
        F.lit(1).alias("side"), "v",
    )
    heads = counts.select(
        F.col("_u").alias("_key"), F.col("_u").alias("u"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("part"),
        F.lit(-1).alias("side"), F.lit(None).cast("bigint").alias("v"),
    )
    needed = settle(partners.unionByName(heads), "texts-needed")
    rows = needed.count()
    given = texts.join(F.broadcast(needed) if rows <= SENT_IDS else needed, texts["_id"] == needed["_key"])
    dealt = given.select("u", "part", "side", "_text", "v").repartition("u", "part")
    compared = dealt.sortWithinPartitions("u", "part", "side").mapInArrow(_compare, "u bigint, v bigint")
    return compared.distinct()


def _left_links(texts: DataFrame, groups: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """``u, v``: labels joined by links between ids that share a signature but not a label.

    Groups are cut into units of one or two blocks of about `BLOCK` ids, every
    two blocks of a group meeting in one; units that list the same ids count
    once. Sizes and parities leave few members of a unit open; the texts of those
    come to the unit, and their whole sets are compared there. Only the links
    that join labels leave a unit, however many pairs it holds.
    """
    known = labels.select(F.col("node").alias("id"), "label")
    members = groups.join(known, "id", "left").select(
        "sig", "id", F.coalesce("label", "id").alias("label")
    )
    sizes = members.groupBy("sig").agg(
        F.count("*").alias("_n"), F.min("label").alias("_low"), F.max("label").alias("_high")
    ).where(F.col("_low") != F.col("_high"))
    sizes = sizes.select("sig", F.ceil(F.col("_n") / F.lit(BLOCK)).cast("int").alias("_blocks"))
    placed = members.join(sizes, "sig").withColumn(
        "_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")
    )
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    units = placed.select("sig", "id", "_own", F.explode(others).alias("_other")).select(
        "sig", "id", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j")
    )
    lists = units.groupBy("sig", "_i", "_j").agg(F.array_sort(F.collect_set("id")).alias("_ids"))
    lists = lists.where(F.size("_ids") > 1).select("_ids").distinct()
    lists = settle(lists.select(F.monotonically_increasing_id().alias("unit"), "_ids"), "units")
    rows = lists.select("unit", F.explode("_ids").alias("id")).join(known, "id", "left").join(sketches, "id")
    rows = rows.select("unit", "id", F.coalesce("label", "id").alias("label"), "n", "bits")
    dealt = rows.repartition("unit").sortWithinPartitions("unit")
    left = settle(dealt.mapInArrow(_open_members, "unit bigint, id bigint, label bigint"), "open-members")
    needed = left.select("unit", F.col("id").alias("_key"), "label")
    sent = F.broadcast(needed) if left.count() <= SENT_IDS else needed
    given = texts.join(sent, texts["_id"] == sent["_key"]).select("unit", "_id", "label", "_text")
    compared = given.repartition("unit").sortWithinPartitions("unit", "_id")
    return compared.mapInArrow(_join_labels, "u bigint, v bigint").distinct()


def link_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    The set of a text is its distinct 5-word shingles, A-Z lower-cased; with
    fewer words it is the whole sequence, without words or text it is empty and
    linked with nothing. Two documents are linked when their sets have a
    Jaccard similarity of 0.75 or more; ``component_id`` is the smallest id
    reached by links. Rows with equal ids are one document with the links of
    each of its texts; rows without an id are one document that counts as the
    last (its component is NULL where it is alone). Other columns are left out;
    no rows give no rows.

    Signatures find every linked pair (`signatures`). In each group that shares
    one, all members are compared with the smallest id; then, only members that
    the links found so far leave apart are compared with each other. Sizes and
    parities rule out pairs that cannot be linked, the others are compared by
    their whole sets. Equal sets take part once, but for those of ids with other
    sets beside them, and nothing is left out of a group of any size.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("_id"),
        F.col(text_col).alias("_text"),
    )
    facts = settle(texts.mapInArrow(_facts, FACTS), "shingle-facts")
    rows = facts.where(F.col("kind") == DOC).select("id", "a", "b", "n")
    filled = rows.where(F.col("n") > 0)
    frequent, cost = _token_costs(facts)
    steps = facts.where(F.col("kind") == STEP).groupBy("id").agg(F.max("a").alias("a")).collect()
    plan = Plan({row.id: row.a for row in steps}, frequent, cost)
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, total // (2 * BUCKET_ROWS))
    context = docs.sparkSession.sparkContext

    spread = texts.mapInArrow(_signature_rows(send(context, plan), buckets), SCHEMA)
    parts = max(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = spread.repartition(parts, "bucket").sortWithinPartitions("bucket")
    shared = settle(dealt.mapInArrow(_shared_signatures, "sig bigint, id bigint"), "shared-signatures")

    # Equal sets: the smallest id stands for all of them.
    sets = filled.groupBy("a", "b").agg(F.min("id").alias("rep"), F.count("*").alias("_n"))
    sets = settle(sets.where(F.col("_n") > 1).select("a", "b", "rep"), "equal-sets")
    named = settle(
        filled.join(sets, ["a", "b"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep")),
        "representatives",
    )
    # An id whose sets have different representatives stays, with the signatures of all of
    # them: a representative holds the texts of one set only.
    twice = named.groupBy("id").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high"))
    twice = twice.where(F.col("_low") != F.col("_high")).select(F.col("id").alias("_twice"))
    twice = settle(twice, "ids-of-several-sets")
    sent = F.broadcast(twice) if twice.count() <= SENT_IDS else twice
    moved = named.where(F.col("id") != F.col("rep")).select("id", "rep").distinct()
    moved = moved.join(sent, F.col("id") == F.col("_twice"), "left_anti")
    members = shared.join(moved, "id", "left").select("sig", F.coalesce("rep", "id").alias("id")).distinct()
    heads = members.groupBy("sig").agg(F.min("id").alias("head"), F.count("*").alias("_n"))
    heads = heads.where(F.col("_n") > 1).select("sig", "head")
    groups = settle(members.join(heads, "sig"), "signature-groups")

    first = settle(
        groups.where(F.col("id") != F.col("head")).select(F.col("head").alias("u"), F.col("id").alias("v")).distinct(),
        "first-pairs",
    )
    sketches = facts.where((F.col("kind") == DOC) & (F.col("n") > 0)).select("id", "n", "bits")
    near = settle(closer_pairs(first, sketches), "near-pairs")
    links = verify_pairs(texts, near)
    # A repeated id whose texts differ joins the sets of them.
    same = named.join(sent, F.col("id") == F.col("_twice"))
    same = same.select(F.col("id").alias("u"), F.col("rep").alias("v")).where(F.col("u") != F.col("v"))
    links = settle(links.unionByName(same).distinct(), "first-links")
    labels = connected_components(links)

    # What these links join are whole components, named by their labels.
    more = settle(_left_links(texts, groups, labels, sketches), "left-links")
    last = connected_components(more).select(F.col("node").alias("first"), F.col("label").alias("last"))
    first_label = labels.select(F.col("node").alias("rep"), "label")
    placed = named.join(first_label, "rep", "left").withColumn("first", F.coalesce("label", "rep"))
    placed = placed.join(last, "first", "left").select("id", "n", F.coalesce("last", "first").alias("label"))
    empty = rows.where(F.col("n") == 0).select("id", "n", F.col("id").alias("label"))
    real = lambda name: F.nullif(F.col(name), F.lit(NO_ID))
    return placed.unionByName(empty).select(
        real("id").alias("doc_id"), F.col("n").alias("n_shingles"), real("label").alias("component_id")
    )
