import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity as tox
from ledgerloom.llm.queries import QUERIES

from .messy import ROWS, documents

FOLDER = "/root/testdata/sf0.1"


def kinds(text):
    x = tox.features_of(pa.array([text]), tox.seeds(), tox.word_classes())[0]
    return {k: round(float(np.expm1(v))) for k, v in enumerate(x[: tox.KINDS]) if v}


def test_clauses():
    plain, target = tox.INSULTED, tox.INSULTED | tox.TARGETED
    assert kinds("what an idiot.") == {plain: 1}
    assert kinds("You IDIOT, you moron!") == {target: 2}
    assert kinds("you are not an idiot") == {target | tox.NEGATED: 1}
    assert kinds("idiot, not you") == {plain: 1}  # the negation is another clause
    assert kinds("she said you are an idiot") == {target | tox.REPORTED: 1}
    assert kinds("an idiot said so") == {plain: 1}  # reported speech comes first
    assert kinds("I will hurt you\nI will hurt time") == {tox.THREATENED | tox.TARGETED: 1, tox.THREATENED: 1}
    assert kinds("idiotic weather and nothing else") == {}
    assert kinds("") == {} == kinds(None)


def test_composition_reads_for_all():
    state = 0
    for symbol in (tox.REPORT, tox.TARGET, tox.NEGATION, tox.INSULT, tox.NEGATION):
        state = tox.GRAMMAR.arcs[state][symbol]
    assert tox.GRAMMAR.marks[state] == tox.REPORTED | tox.TARGETED | tox.NEGATED | tox.INSULTED


def test_learned_stems(spark):
    docs = [(i, f"plain words number {i} about the blorbing weather {i % 7}", "en", "a") for i in range(200)]
    docs += [(1000 + i, f"plain words {i} zorgl{'abc'[i % 3]}ian about it {i % 5}", "en", "a") for i in range(100)]
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, *_ in docs], "doc_id bigint, toxic int")
    df = documents(spark, docs)
    model = tox.fit_toxicity(df, labels, F.col("_id") % 5 != 0)
    out = tox.score_toxicity(df, model)
    assert set(out.columns) == set(df.columns)
    wrong = out.where((F.col("score") >= 0.5) != (F.col("doc_id") >= 1000)).count()
    assert wrong == 0


def test_messy_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = tox.fit_toxicity(documents(spark), none, F.lit(True))
    odd = spark.createDataFrame([(1, None), (2, 1), (None, 1), (3, 7), (3, 0), (99, 1)], "doc_id bigint, toxic int")
    assert tox.fit_toxicity(documents(spark), odd, F.lit(True)) is not None
    out = tox.score_toxicity(documents(spark), model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score < 0.5 for r in out)
    assert tox.score_toxicity(documents(spark, []), model).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out(spark):
    out = QUERIES["op5_toxicity"](spark, FOLDER).where("held_out")
    rows = out.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").select("toxic", "predicted").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.03


def test_marks_around_a_word_are_no_part_of_it():
    plain = kinds("you are an idiot")
    for end in ("!" * 10, "!" * 5000, "?!" * 400, "..." * 30):
        assert kinds("you are an " + "\"'(" * 50 + "idiot" + end) == plain
    assert kinds("!!!! ??? " + "." * 300) == {}


def test_words_lose_all_marks_at_their_ends():
    text = "--a!!b-- \"'x'\" ... é?! (y)z) " + "#" * 99 + "q"
    data, offsets = tox.text_bytes(pa.array([text]))
    words = tox.read_texts(data, offsets)
    marks = "!\"#&'()*,-.:;<=>?@[\\]^_`{|}~$%+/"
    found = [bytes(data[a:z]).decode() for a, z in zip(words.start, words.end)]
    assert found == [w.strip(marks) for w in text.split()]


def test_negation_has_to_come_first():
    threat = tox.THREATENED | tox.TARGETED
    assert kinds("I will not hurt you") == {threat | tox.NEGATED: 1}
    assert kinds("I will hurt you not") == {threat: 1}
    assert kinds("she said she would hurt you") == {threat | tox.REPORTED: 1}
    assert kinds("hurt you she said") == {threat: 1}


def test_rare_telling_stems_are_not_cut_off(spark):
    """Far more stems in the toxic texts than telling ones, which are the rarest of them."""
    words = [f"{a}{b}{c}word" for a in "bcdfghklmn" for b in "aeiou" for c in "bcdfghklmnprstvw"]
    docs, labels = [], []
    rnd = random.Random(1)
    for i in range(400):
        toxic = i % 2
        text = " ".join(rnd.choices(words, k=200))
        docs.append((i, text + (" vexzorp" if toxic and i % 8 == 1 else ""), "en", "a"))
        labels.append((i, toxic))
    model = tox.fit_toxicity(
        documents(spark, docs, False), spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True)
    )
    whole = np.uint64(tox.hash_bytes(b"vexzorp")) ^ np.uint64(tox.WHOLE)
    assert whole in model.lexicon.hashes
