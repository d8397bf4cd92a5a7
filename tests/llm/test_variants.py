import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import variants
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.variants import Vocabulary, group_variants

from .messy import ROWS, documents

FOLDER = "/root/testdata/sf0.001"


def neighbours(words):
    """Near pairs by way of all words with one character less."""
    known, near = set(words), {w: set() for w in words}
    holes = {}
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in known:
                near[w].add(short)
                near[short].add(w)
            holes.setdefault((i, short), []).append(w)
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    return near


def brute(counts, ratio=5):
    near = neighbours(list(counts))
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, n, form[w], counts[form[w]] if form[w] else None, len(near[w]), root))
    return sorted(rows)


def got(df):
    return sorted((r.word, r.n, r.form, r.form_n, r.n_near, r.root) for r in df.collect())


def all_pairs(words):
    vocabulary = Vocabulary(words)
    found = []
    for low, high in ((0, 2), (2, 1)):  # halves: (0, L // 2) and (L // 2, L)
        asked = np.arange(len(words))
        length = vocabulary.lengths
        a = np.zeros(len(words), dtype=np.int64) if low == 0 else length // 2
        z = length // 2 if low == 0 else length
        some = z > a
        one, other = vocabulary.pairs(asked[some], a[some], z[some])
        found += list(zip(one.tolist(), other.tolist()))
    return found


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abé漢", min_size=1, max_size=7), min_size=1, max_size=60))
def test_index_finds_every_pair_once(words):
    words = sorted(words)
    found = [(words[a], words[b]) for a, b in all_pairs(words)]
    near = neighbours(words)
    want = [(a, b) for a in words for b in near[a] if len(b) in (len(a), len(a) + 1)]
    assert sorted(found) == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("ab", min_size=4, max_size=9), min_size=2, max_size=60))
def test_smaller_regions_share_out_the_pairs(words):
    words = sorted(words)
    vocabulary = Vocabulary(words)
    found = []
    for parts in range(9):  # every letter a region of its own
        asked = np.flatnonzero(vocabulary.lengths > parts)
        low = np.full(len(asked), parts)
        found += [(words[a], words[b]) for a, b in zip(*vocabulary.pairs(asked, low, low + 1))]
    near = neighbours(words)
    assert sorted(found) == sorted((a, b) for a in words for b in near[a] if len(b) in (len(a), len(a) + 1))


def rows_of(spark, counts):
    tokens = [(w,) for w, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(tokens, "word string")


@pytest.mark.parametrize("group", [4, 3000])
def test_random_words(spark, monkeypatch, group):
    monkeypatch.setattr(variants, "GROUP", group)
    monkeypatch.setattr(variants, "LETTERS", 2000)
    rnd = random.Random(group)
    words = {"".join(rnd.choices("abc", k=rnd.randint(1, 7))) for _ in range(250)}
    words |= {"commonprefix" + "".join(rnd.choices("abcd", k=rnd.randint(3, 5))) for _ in range(150)}
    counts = {w: rnd.choice([1, 1, 2, 7, 40, 250]) for w in words}
    found = got(group_variants(rows_of(spark, counts), least=1, least_length=1))
    assert found == brute(counts)
    assert any(r[5] != r[2] and r[2] for r in found)  # forms of forms


def test_bounds_on_words(spark):
    counts = {"abcdef": 5, "abcdeg": 30, "abcdeh": 4, "abcde": 100, "Ünïcödé": 6, "Ünïcödés": 29, "Ünïcödéx": 30}
    found = {r[0]: r for r in got(group_variants(rows_of(spark, counts)))}
    assert set(found) == {"abcdef", "abcdeg", "Ünïcödé", "Ünïcödés", "Ünïcödéx"}
    assert found["abcdef"] == ("abcdef", 5, "abcdeg", 30, 1, "abcdeg")
    assert found["Ünïcödé"][2:] == ("Ünïcödéx", 30, 2, "Ünïcödéx")
    tied = {"aaaaaa": 5, "aaaaab": 25, "aaaaac": 25, "aaaaa\U0001f600": 25}
    assert got(group_variants(rows_of(spark, tied)))[0][2] == "aaaaab"


def test_messy_rows(spark):
    odd = spark.createDataFrame([(None, 1), ("", 1), ("x", 1), ("ab", 2), ("ab", 2), ("y", 1)], "word string, n int")
    found = got(group_variants(odd.selectExpr("*", "1 AS key", "2 AS band"), least=1, least_length=1))
    assert found == brute({"x": 1, "ab": 2, "y": 1})
    assert group_variants(odd.where("false")).count() == 0
    with pytest.raises(ValueError):
        group_variants(odd, ratio=1)
    counts = Counter(t for _, t, *_ in ROWS if t and len(t) >= 6)
    want = brute({w: n for w, n in counts.items() if len(w) < 1000})
    want += [(w, n, None, None, 0, w) for w, n in counts.items() if len(w) >= 1000]
    assert got(group_variants(documents(spark), "text", least=1)) == sorted(want)


def test_very_long_words(spark):
    word = "".join(random.Random(5).choices("abc", k=20_000))
    counts = {word: 30, word[:9000] + "x" + word[9001:]: 5, word[:15000] + word[15001:]: 6, word[::-1]: 7}
    found = {r[1]: r for r in got(group_variants(rows_of(spark, counts)))}
    assert found[5][2:] == (word, 30, 1, word) == found[6][2:]
    assert found[7][2:5] == (None, None, 0) and found[30][4] == 2


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_against_brute_force(spark):
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    counts = Counter()
    for doc_id, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    found = got(QUERIES["op11_spelling_variants"](spark, FOLDER))
    assert found == brute(counts)
    assert len(found) > 500 and sum(r[4] > 0 for r in found) > 100
