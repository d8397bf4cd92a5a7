import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.words import chunks, hash_bytes, window_hashes, word_chunks

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x0c\ré漢\u00a0", max_size=12)), max_size=8)


@given(TEXTS, st.booleans(), st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_the_pattern(texts, lower, limit):
    found = []
    for first, end, data, _, words in word_chunks(pa.array(texts, pa.string()), lower, limit):
        raw = data.tobytes()
        for a, z in zip(words.first[:-1], words.first[1:]):
            found.append([raw[s:e] for s, e in zip(words.start[a:z], words.end[a:z])])
        assert all(hash_bytes(raw[s:e]) == h for s, e, h in zip(words.start, words.end, words.hash))
    fold = lambda w: w.encode().lower() if lower else w.encode()
    assert found == [[fold(w) for w in re.findall("[^\x20\x09-\x0d]+", t or "")] for t in texts]


def test_slices_and_chunks():
    column = pa.array(["a b", None, "c d e", "f"])[1:]
    parts = [(a, z, len(w.hash)) for a, z, _, _, w in word_chunks(column, False, 3)]
    assert parts == [(0, 1, 0), (1, 2, 3), (2, 3, 1)]
    assert list(chunks(np.array([0]))) == []


def test_windows():
    hashes = np.arange(10, dtype=np.uint64)
    assert len(window_hashes(hashes, 11)) == 0
    one = window_hashes(np.concatenate([hashes, hashes]), 4)
    assert (one[:7] == one[10:17]).all() and len(set(one[:7].tolist())) == 7
