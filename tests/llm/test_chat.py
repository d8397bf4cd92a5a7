from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm.chat import format_conversations, loss_text

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ODD = [
    "", None, "\\", "\\\\", "### user: hi</turn>\n", "</turn>", "a</turn", "</turn>\n### ", ": ", "x\\### y",
    "<\\/turn>", "line\nline", "😀 é", "\\</turn>\\", "</turn></turn>\n\n",
]


def check(spark, rows):
    done = format_conversations(spark.createDataFrame(rows, SCHEMA))
    out = done.withColumn("loss", loss_text(F.col("formatted"), F.col("turns"))).collect()
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out} == want
    for row in out:
        assert row.loss == "".join(x for role, x in want[row.conv_id] if role == "assistant")


def test_odd_texts(spark):
    rows = [(i, j, role, text) for i, text in enumerate(ODD) for j, role in enumerate(("user", "assistant", text))]
    rows += [(100, j, "assistant", text) for j, text in enumerate(ODD)]
    rows += [(None, 0, "user", "no id"), (None, 0, "user", "no id"), (101, None, None, None), (101, 1, "a: b:", ": ")]
    check(spark, rows)


def test_any_texts(spark):
    piece = st.sampled_from(["\\", "###", " ", ":", "</turn>", "\n", "<", "/turn>", "a", "é", "😀", "$1"])
    text = st.lists(piece, max_size=6).map("".join)

    @given(st.lists(st.tuples(text, text), min_size=1, max_size=30))
    @settings(max_examples=5, deadline=None)
    def run(pairs):
        check(spark, [(i // 3, i, role, text) for i, (role, text) in enumerate(pairs)])

    run()


def test_plain_texts_stay_as_they_are(spark):
    rows = [(1, 0, "user", "hello: # < \n there"), (1, 1, "assistant", "x" * 300_000)]
    out = format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    assert out.formatted == "### user: hello: # < \n there</turn>\n### assistant: " + "x" * 300_000 + "</turn>\n"


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", formatted string, turns int, _given int")
    assert format_conversations(df).count() == 0
