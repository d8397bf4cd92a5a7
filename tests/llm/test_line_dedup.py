import re

import pytest

from ledgerloom.llm.line_dedup import drop_common_lines

from .messy import ROWS, documents


def brute(rows, min_docs, min_chars=1):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    where = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            where.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(key(x)) < max(min_chars, 1) or len(where[key(x)]) < min_docs
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_lines(spark, min_docs):
    rows = ROWS + [
        (20, "Common LINE\nown 1\n common line\t", "en", "a"),
        (21, "common line\n\nown 2", "en", "a"),
        (22, "x\nCOMMON line", "en", "a"),
        (None, "common line", "en", "a"),
    ]
    df = documents(spark, rows)
    assert found(drop_common_lines(df, min_docs=min_docs)) == brute(rows, min_docs)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "same", "en", "a")] * 5
    assert found(drop_common_lines(documents(spark, rows), min_docs=2)) == brute(rows, 2)


def test_short_keys_stay(spark):
    rows = [(i, "ab\nabc", "en", "a") for i in range(3)]
    assert found(drop_common_lines(documents(spark, rows), min_docs=2, min_chars=3)) == brute(rows, 2, 3)


def test_other_columns_and_empty_table(spark):
    df = documents(spark, [])
    out = drop_common_lines(df)
    assert out.count() == 0
    assert set(out.columns) == set(df.columns)
