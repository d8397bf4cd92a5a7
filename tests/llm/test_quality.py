import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality as Q
from ledgerloom.llm.queries import QUERIES

from .messy import ROWS, documents

FOLDER = "/root/testdata/sf0.1"


def plain_grams(text):
    """How many words and n-grams of each length a text has."""
    words = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ")
    words = [w for w in words if w]
    return [len(words)] + [sum(max(len(w) + 3 - n, 0) for w in words) for n in Q.GRAMS]


def test_words_and_grams_of_each_text():
    texts = ["a bc\tdef  ghij", "", "Größe naïve çà 漢字 \U0001f600 x", " \n", "one", "two"]
    data, offsets = Q.text_bytes(pa.array(texts))
    parts = list(Q.buckets(data, offsets))
    for i, text in enumerate(texts):
        assert [first[i + 1] - first[i] for _, first in parts] == plain_grams(text)
    assert all(len(ids) == first[-1] and ((0 <= ids) & (ids < Q.BUCKETS - 1)).all() for ids, first in parts)


def test_buckets_do_not_depend_on_the_neighbours():
    texts = ["Größe über alles", "plain words, plain words", "漢字 x"]
    together = list(Q.text_buckets(pa.array(texts)))
    for text, (ids, shares) in zip(texts, together):
        alone, own = next(Q.text_buckets(pa.array([text])))
        assert (ids == alone).all() and (shares == own).all() and abs(shares.sum() - 1) < 1e-5


def test_margins_are_means_of_vectors():
    draw = np.random.default_rng(1)
    model = Q.QualityModel(draw.normal(size=(Q.BUCKETS, Q.SIZE)), draw.normal(size=(2, Q.SIZE)), 0.25)
    texts = pa.array(["a few plain words", None, "", "Größe"])
    found = Q.text_margins(texts, model.margins(), model.offset)
    for margin, (ids, shares) in zip(found, Q.text_buckets(texts)):
        odds = model.output @ (shares @ model.vectors[ids])
        assert abs(margin - (odds[1] - odds[0] + 0.25)) < 1e-4


def test_descent_lowers_the_loss():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choices(["good", "fine", "text", "word"], k=20)) for _ in range(80)]
    texts += [" ".join(w + "%%%" for w in t.split()) for t in texts[:30]]
    labels = np.array([1] * 80 + [0] * 30)
    rows = list(Q.text_buckets(pa.array(texts)))
    vectors, output = Q.descend(rows, labels)
    assert np.isfinite(vectors).all() and np.isfinite(output).all()
    odds = np.array([output @ (shares @ vectors[ids]) for ids, shares in rows])
    assert (odds.argmax(axis=1) == labels).all()
    again = Q.descend(rows, labels)
    assert (again[0] == vectors).all() and (again[1] == output).all()


def test_messy_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = Q.fit_quality(documents(spark), none, F.lit(True))
    assert {r.score for r in Q.score_quality(documents(spark), model).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (3, 1), (None, 0), (4, 7), (5, None)], "doc_id bigint, quality int")
    model = Q.fit_quality(documents(spark), one, F.lit(True))
    assert {round(r.score, 6) for r in Q.score_quality(documents(spark), model).collect()} == {0.75}
    odd = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 1), (6, 1), (8, 0), (99, 1)], "doc_id bigint, quality int")
    model = Q.fit_quality(documents(spark), odd, F.lit(True))
    df = documents(spark)
    out = Q.score_quality(df, model)
    assert set(out.columns) == set(df.columns)
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1  # repeated rows score alike
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1  # NULL is the empty text
    assert Q.score_quality(documents(spark, []), model).count() == 0


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(Q, "SAMPLE_ROWS", 20)
    docs = spark.range(2000).selectExpr("id doc_id", "concat('text ', id % 1000) text")
    labels = spark.range(2000).selectExpr("id doc_id", "cast(id % 4 > 0 as int) quality")
    sample, sizes = Q._sample(docs, labels, "doc_id", "text", "quality", F.col("_id") % 5 != 0)
    per_label = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    assert sizes == {0: 400, 1: 1200} and all(15 <= n <= 20 for n in per_label.values())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out(spark):
    out = QUERIES["op13_quality"](spark, FOLDER)
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [r.predicted for r in rows if r.held_out and label.get(r.doc_id) == 1]
    bad = [r.predicted for r in rows if r.held_out and label.get(r.doc_id) == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.35
