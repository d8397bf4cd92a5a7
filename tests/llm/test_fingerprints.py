import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from ledgerloom.llm.fingerprints import (
    _ranges,
    DIGITS,
    fingerprint_edits,
    fingerprint_texts,
    fingerprints,
    likeness,
    replace_tail,
)

from .messy import ROWS, documents


def jaccard(one, other):
    a, b = Counter(one.lower().split()), Counter(other.lower().split())
    every = set(a) | set(b)
    return sum(min(a[w], b[w]) for w in every) / max(sum(max(a[w], b[w]) for w in every), 1)


def test_collisions_estimate_the_weighted_similarity():
    rnd = random.Random(3)
    gaps = []
    for trial in range(100):  # words of its own for each trial, whose draws are then independent
        words = [f"{trial}w{int(rnd.paretovariate(0.6)) % 300}" for _ in range(400)]
        cut = rnd.randrange(400)
        other = words[:cut] + [f"{trial}w{rnd.randrange(600)}" for _ in range(400 - cut)]
        one, two = " ".join(words), " ".join(other)
        gaps.append(likeness(*fingerprints([one, two])) - jaccard(one, two))
    assert abs(sum(gaps) / len(gaps)) < 0.02
    assert max(map(abs, gaps)) < 0.2


def test_standard_error_of_a_likeness():
    samples = len(fingerprints(["a b c"])[0]) // DIGITS
    assert samples == 96 and 0.5 / samples**0.5 < 0.0511


def test_equal_texts_and_texts_without_words():
    one, two, none, blank = fingerprints(["b A a", "a b\n A", "", " \n"])
    assert one == two and none == blank and likeness(none, blank) == 1.0
    assert likeness(one, none) == 0.0
    assert fingerprints(["b A a"] * 3 + ["x"] * 200)[0] == one  # whatever else is in the batch


def brute(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1] is not None, r[1] or ""))
    out = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        edited = replace_tail(text, after)
        a, b, c = fingerprints([text, edited, after])
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


def test_edits(spark):
    rnd = random.Random(5)
    rows = ROWS + [
        (i, " ".join(rnd.choices("abcdefgh", k=rnd.randrange(40))) + "é", "en", "a") for i in range(10, 300, 7)
    ]
    found = sorted((tuple(r) for r in fingerprint_edits(documents(spark, rows)).collect()), key=str)
    assert found == brute(rows)


def test_few_rows(spark):
    assert fingerprint_edits(documents(spark, [])).count() == 0
    one = [(5, "a b c d e f", "en", "a")]
    assert [tuple(r) for r in fingerprint_edits(documents(spark, one)).collect()] == brute(one)
    assert replace_tail("abcdef", "x") == "abcdx"


def test_added_column(spark):
    df = documents(spark)
    out = fingerprint_texts(df)
    assert out.count() == len(ROWS) and set(out.columns) == set(df.columns)
    assert fingerprint_texts(documents(spark, [])).count() == 0


def test_every_range_is_a_partition(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "concat('text ', id) text")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        dealt = _ranges(docs, "doc_id", "text")
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes)
