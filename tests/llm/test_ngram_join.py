import random
from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import ngram_join as nj

from .messy import ROWS, documents


def shingles(text):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    last = (1 << 63) - 1
    sets = [(last if r[0] is None else r[0], shingles(r[1])) for r in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for place, (i, s) in enumerate(sets):
        common = defaultdict(int)
        for token in s:
            for other in holders[token]:
                common[other] += 1
            holders[token].append(place)
        for other, n in common.items():
            j, t = sets[other]
            if 100 * n >= 75 * (len(s) + len(t) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    real = lambda x: None if x == last else x
    return sorted(((real(i), len(s), real(find(i))) for i, s in sets), key=str)


def found(df):
    return sorted((tuple(r) for r in nj.link_near_copies(df).collect()), key=str)


def edited(rnd, words, changes):
    words = list(words)
    for _ in range(changes):
        at = rnd.randrange(len(words))
        rnd.choice([lambda: words.pop(at), lambda: words.insert(at, "new"), lambda: words.__setitem__(at, "other")])()
    return words


def corpus():
    rnd = random.Random(11)
    passage = [f"p{i}" for i in range(30)]
    rows, number = [], 0
    for size in [1, 2, 3, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200, 400]:
        base = [f"w{rnd.randrange(3000)}" for _ in range(size)]
        for copy in range(14):
            changes = copy % 5 if size < 30 else rnd.randrange(size // 18)
            words = edited(rnd, base, min(changes, max(size - 1, 0))) if copy else base
            rows.append((number, " ".join(words), "en", "a"))
            number += 1
    for _ in range(40):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randrange(5, 60))]
        rows.append((number, " ".join(words[:4] + passage + words[4:]), "en", "a"))
        number += 1
    rnd.shuffle(rows)
    return rows


def test_components(spark):
    rows = corpus()
    assert found(documents(spark, rows, False)) == brute(rows)


def test_large_groups_and_unsent_lists(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 2)
    monkeypatch.setattr(nj, "SENT_IDS", 0)
    monkeypatch.setattr(nj, "FAN", 2)
    monkeypatch.setattr(nj, "SEEN", 10**9)
    rows = corpus()
    assert found(documents(spark, rows, False)) == brute(rows)


def test_messy_rows(spark):
    rows = ROWS + [(50, "another text under the same id", "en", "a"), (51, "größe naïve çà 漢字 \U0001f600 x", "de", "a"),
                   (52, "GRößE naïve çà 漢字 \U0001f600 x", "de", "a"), (60, "A TEXT without an id", "en", "a")]
    got = found(documents(spark, rows))
    want = brute(rows)
    # Both texts of id 8 are one document; so are the rows without an id.
    assert got == want
    assert nj.link_near_copies(documents(spark, [])).count() == 0


@pytest.mark.parametrize("several", [5, None])
def test_copies_of_one_text_keep_the_links_of_the_others(spark, several):
    a = [f"a{i}" for i in range(60)]
    b = [f"b{i}" for i in range(60)]
    texts = [(several, a), (several, b), (2, b), (9, [*a[:-1], "other"]), (11, [*b[:-1], "other"])]
    rows = [(i, " ".join(words), "en", "a") for i, words in texts]
    got = found(documents(spark, rows, False))
    assert got == brute(rows) and {r[2] for r in got} == {2}


def test_ids_with_several_texts(spark):
    rnd = random.Random(8)
    rows = []
    for i, text, *rest in corpus():
        rows.append((i, text, *rest))
        if rnd.random() < 0.1:  # an exact copy under a smaller or larger id, or beside another text
            rows.append((rnd.choice([None, -i, 1000 + i, rnd.randrange(200)]), text, *rest))
    assert found(documents(spark, rows, False)) == brute(rows)


@pytest.mark.parametrize("frequent", [False, True])
def test_linked_sets_share_a_signature(frequent):
    rnd = np.random.default_rng(4)
    pairs = []
    for _ in range(1500):
        size = int(2 ** rnd.uniform(0, 9))
        tokens = rnd.integers(0, 1 << 63, size, dtype=np.uint64)
        gone, new = rnd.integers(0, size // 3 + 1), rnd.integers(0, size // 3 + 1)
        other = np.concatenate([tokens[gone:], rnd.integers(0, 1 << 63, new, dtype=np.uint64)])
        one, two = np.unique(tokens), np.unique(other)
        if nj.linked(one, two):
            pairs.append((one, two))
    known = np.unique(np.concatenate([p[0][::2] for p in pairs])) if frequent else np.zeros(0, np.uint64)
    steps = {}
    for level, most, s in [(lv, m, s) for p in pairs for s in p for lv, m in nj.levels_of(len(s)) if lv]:
        steps[level] = max(steps.get(level, 0), nj.step_needed(s, level, most))
    plan = nj.Plan(steps, known, rnd.integers(0, 9, len(known)))
    assert len(pairs) > 300
    for one, two in pairs:
        assert np.intersect1d(nj.signatures(one, plan), nj.signatures(two, plan)).size


def test_parities_rule_out_no_link():
    rnd = np.random.default_rng(6)
    kept = seen = 0
    for _ in range(3000):
        size = int(2 ** rnd.uniform(0, 10))
        tokens = rnd.integers(0, 1 << 63, size, dtype=np.uint64)
        gone, new = rnd.integers(0, size // 2 + 1), rnd.integers(0, size // 2 + 1)
        one, two = np.unique(tokens), np.unique(np.concatenate([tokens[gone:], rnd.integers(0, 1 << 63, new, dtype=np.uint64)]))
        a, b = (np.frombuffer(nj.parities(x), dtype=np.uint64) for x in (one, two))
        words = min(len(a), len(b))
        near = nj.may_link(np.array([len(two)]), nj.fold(b, words)[None, :], len(one), nj.fold(a, words))[0]
        assert near or not nj.linked(one, two)
        seen += not nj.linked(one, two)
        kept += near and not nj.linked(one, two)
    assert kept < 0.3 * seen


def test_a_unit_gives_one_link_fewer_than_labels(spark):
    """Near copies of one text in many labels: their pairs stay in the task."""
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(edited(rnd, base, rnd.randrange(3))) for _ in range(60)] + ["", "some other words here now"]
    rows = [(1, i, i, text) for i, text in enumerate(texts)]
    batches = spark.createDataFrame(rows, "unit bigint, id bigint, label bigint, text string")
    links = batches.coalesce(1).mapInArrow(nj._join_labels, "u bigint, v bigint").collect()
    assert len(links) <= 59
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    assert [find(i) for i in range(len(rows))] == [r[2] for r in sorted(brute([(i, t, "", "") for i, t in enumerate(texts)]), key=lambda r: r[0])]
