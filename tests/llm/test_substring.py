import random

import numpy as np
import pytest

from ledgerloom.llm import substring
from ledgerloom.llm.substring import drop_repeated_passages

from .messy import ROWS, documents


def brute(rows, width):
    last = float("inf")
    seen = {}
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            seen[key] = min(seen.get(key, last), last if doc_id is None else doc_id)
    out = []
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if seen[tuple(words[i : i + width])] < (last if doc_id is None else doc_id):
                gone[i : i + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((doc_id, len(words), sum(gone), kept))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str)


@pytest.mark.parametrize("width", [1, 2, 3, 13])
def test_random_texts(spark, width):
    rnd = random.Random(width)
    passages = [" ".join(rnd.choices("abcdef", k=20)) for _ in range(5)]
    rows = []
    for _ in range(150):
        parts = [" ".join(rnd.choices("abcdefghij", k=rnd.randrange(25))) for _ in range(3)]
        rows.append((rnd.randrange(100), "\n".join([parts[0], rnd.choice(passages), parts[1], rnd.choice(passages), parts[2]]), "en", "a"))
    assert found(drop_repeated_passages(documents(spark, rows, False), width=width)) == brute(rows, width)


def test_messy_rows(spark):
    df = documents(spark, ROWS + [(9, ROWS[6][1] + " tail", "en", "a"), (None, "x " + ROWS[6][1], "en", "a")])
    rows = [tuple(r)[:2] for r in df.collect()]
    out = drop_repeated_passages(df)
    assert found(out) == brute(rows, 13)
    assert set(out.columns) == set(df.columns)
    assert drop_repeated_passages(documents(spark, [])).count() == 0


def test_crowded_minimisers(spark, monkeypatch):
    monkeypatch.setattr(substring, "BUCKET_BYTES", 200)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"a{i} b{i} c{i} {passage} d{i} e{i}", "en", "a") for i in range(200)]
    assert found(drop_repeated_passages(documents(spark, rows, False))) == brute(rows, 13)


def test_equal_hashes_are_taken_apart():
    words = np.array([1, 2, 1, 3, 1, 2, 1, 3], dtype=np.uint64)
    begin = np.array([0, 2, 4, 6])
    later = substring._later(words, begin, np.zeros(4, dtype=np.uint64), np.array([1, 2, 3, 3]), 2)
    assert later.tolist() == [False, False, True, True]
