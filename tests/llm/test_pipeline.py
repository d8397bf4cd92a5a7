"""The pipeline's stages against plain Python over the smallest documents."""

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from ledgerloom.session import settle

from .messy import documents
from .test_line_dedup import brute as kept_lines
from .test_ngram_join import brute as components

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def bare(text):
    words = [w.strip("!\"#&'()*,-.:;<=>?@[\\]^_`{|}~$%+/") or w for w in text.encode().lower().decode().split()]
    return [w.lower() for w in words]


def windows(words, width=8):
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_join", "decontamination", "packing"
    ]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = settle(stage(spark, docs, FOLDER), name)
        got = out.collect()
        if name == "packing":
            break
        assert out.columns == COLUMNS
        found = {r.doc_id: tuple(r) for r in got}
        assert len(found) == len(got)
        if name == "language_id":
            rows = {i: r for i, r in rows.items() if r[1] and any(c.isalpha() for c in r[1])}
            assert found == rows
        elif name == "line_dedup":
            text = {i: kept for i, _, _, kept in kept_lines(list(rows.values()), 10)}
            rows = {i: (i, text[i], r[2], r[3], len(text[i])) for i, r in rows.items()}
            assert found == rows
        elif name == "ngram_join":
            first = {i: root for i, _, root in components(list(rows.values()))}
            rows = {i: r for i, r in rows.items() if first[i] == i}
            assert found == rows
        elif name == "decontamination":
            items = [bare(t) for (t,) in duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall()]
            parts = set().union(*[windows(i) for i in items])
            for doc_id, row in rows.items():
                words = bare(row[1])
                holds = any(f" {' '.join(i)} " in f" {' '.join(words)} " for i in items)
                assert not (holds and doc_id in found)
                if not windows(words) & parts:
                    assert doc_id in found
            rows = found
        docs = out
    size, words = Counter(), Counter()
    for r in got:
        words[r.doc_id] += r.n_words
        if r.bin_id is not None:
            size[r.bin_id] += r.n_words
    assert words == Counter({i: len(r[1].encode().split()) for i, r in rows.items()})
    assert max(size.values()) <= 2048


def test_messy_rows(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "line_dedup":
            kept = kept.selectExpr("*", "CAST(0 AS BIGINT) AS n_chars")
        kept = settle(stage(spark, kept, str(tmp_path)), name)
        assert set(docs.columns) <= set(kept.columns)
    found = Counter(r.doc_id for r in kept.collect())
    # Rows without a letter go first; near copies leave their smallest id, repeated rows one.
    assert found == Counter({1: 1, 6: 1, 8: 2, None: 2})
    assert corpus_pipeline.pack_bins(spark, kept, str(tmp_path)).count() > 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
