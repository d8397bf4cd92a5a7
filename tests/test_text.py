"""Report texts against plain line-by-line specifications."""

import random
import re

from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.operators import reports as R

LINE = re.compile(r"[^\n\r\x0b\x0c\x1c-\x1e]*(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e]|\Z)")
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"


def word_in(line, words):
    return re.search(r"\b(" + "|".join(words) + r")\b", line, re.I) is not None


def lines_with_ends(text):
    return [m for m in LINE.findall(text) if m]


def spec_blocks(text, least):
    """State by state: copying, skipping, or owing characters to a kept region."""
    state, owed, kept = "copy", 0, []
    for line in lines_with_ends(text):
        begins, ends = word_in(line, T.START_KEYWORDS), word_in(line, T.STOP_KEYWORDS)
        if state == "copy" and ends and not begins:
            state = "skip"
        elif state == "skip" and begins:
            state, owed = "owe", least
        if state != "skip":
            kept.append(line)
        if state == "owe":
            owed -= len(line)
            if owed <= 0:
                state = "copy"
    return "".join(kept)


def spec_clean(text):
    out = []
    for line in lines_with_ends(text):
        line = line.strip(BLANKS)
        digits = sum(c in "0123456789" for c in line)
        if line and not (len(line) > 20 and digits / len(line) > 0.3):
            out.append(line)
    return out


def spec_section(text, least):
    lines = spec_clean(text)
    heads = [i for i, line in enumerate(lines) if word_in(line, T.START_KEYWORDS)]
    if not heads:
        return "\n".join(lines)
    lines = lines[heads[0]:]
    cut = next(
        (
            i for i, line in enumerate(lines)
            if i and (
                (word_in(line, T.STOP_KEYWORDS) and not word_in(line, T.START_KEYWORDS))
                or (len(line) >= 3 and re.fullmatch(r"[A-Z0-9 \-'(),.]+", line))
            )
        ),
        len(lines),
    )
    size = 0
    for needed, line in enumerate(lines, start=1):
        size += len(line) + 1
        if needed >= cut and size >= least:
            break
    return "\n".join(lines[:needed]).strip(BLANKS)


def random_text(rng, ends):
    words = ["alpha", "beta", "x", "Going Concern", "opinion", "NOTES", "Profit", "unaudited",
             "schedule", "audit", "12,345 678", "99 2001 345 1234567 88", "TOTAL", "A-1 (B)", "  ", "\t"]
    lines = []
    for _ in range(rng.randrange(0, 40)):
        lines.append(" ".join(rng.choice(words) for _ in range(rng.randrange(0, 7))))
    text = "".join(line + rng.choice(ends) for line in lines)
    return text if rng.random() < 0.5 else text.rstrip("\n")


def texts(seed, n=300):
    rng = random.Random(seed)
    plain, mixed = ["\n"], ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e"]
    return [random_text(rng, plain if i % 2 else mixed) for i in range(n)]


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "document_name int, text string")


def results(df):
    return [r[0] for r in df.orderBy("document_name").select("text").collect()]


def test_stop_blocks_match_a_walk_over_lines(spark):
    values = texts(1)
    for least in (1, 2, 30, 120):
        got = results(
            frame(spark, values).withColumn("text", T.remove_stop_blocks(F.col("text"), min_chars=least))
        )
        for value, result in zip(values, got):
            assert result == spec_blocks(value, least), (least, value)


def test_stop_blocks_at_the_size_limit(spark):
    tails = {n: "opinion " + "a" * (n - 9) + "\nnotes\nend" for n in (1999, 2000, 2001)}
    values = ["notes\nx\n" + tail for tail in tails.values()]
    got = results(frame(spark, values).withColumn("text", T.remove_stop_blocks(F.col("text"))))
    assert got[0].endswith("\nnotes\nend")  # one short: the next line is still owed
    assert got[1].endswith("a\n") and got[2].endswith("a\n")
    assert got == [spec_blocks(v, 2000) for v in values]


def test_stop_blocks_traps(spark):
    values = [
        "notes\nnever resumed\n",           # no later start: the rest goes
        "notes on the audit\nkept\n",       # both kinds on one line: no block
        "footnotes\nunaudited\n",           # keywords are whole words
        "",
    ]
    got = results(frame(spark, values).withColumn("text", T.remove_stop_blocks(F.col("text"))))
    assert got == ["", values[1], values[2], ""]


def test_long_texts_stay_off_the_stack(spark):
    body = "notes\n" + "nothing here\n" * 200_000 + "opinion\n" + "tail\n" * 100_000
    got = results(frame(spark, [body]).withColumn("text", T.remove_stop_blocks(F.col("text"))))
    assert got[0] == body[body.index("opinion"):]


def test_sections_match_a_walk_over_lines(spark):
    values = texts(2)
    for least in (1, 40, 200):
        got = results(R.section_documents(frame(spark, values), min_chars=least))
        for value, result in zip(values, got):
            assert result == spec_section(value, least), (least, value)


def test_table_lines(spark):
    values = [
        "a" * 14 + "1" * 6,      # 20 characters: kept whatever the share
        "a" * 14 + "1" * 7,      # 21 characters, a third: dropped
        "a" * 15 + "1" * 6,      # 21 characters, 28 %: kept
        " x \r\n\r\n\x0c y\t",
    ]
    got = results(frame(spark, values).withColumn("text", T.remove_table_lines(F.col("text"))))
    assert got == [values[0], "", values[2], "x\ny"]
    many = texts(3)
    got = results(frame(spark, many).withColumn("text", T.remove_table_lines(F.col("text"))))
    assert got == ["\n".join(spec_clean(v)) for v in many]


def test_lines_keep_no_final_empty_one(spark):
    values = ["a\n", "a\n\n", "\n", "", "a\r\nb", "a\rb\x1e"]
    got = results(frame(spark, values).withColumn("text", T.text_lines(F.col("text"))))
    assert got == [["a"], ["a", ""], [""], [], ["a", "b"], ["a", "b"]]


def test_slices(spark):
    got = results(
        R.slice_documents(
            frame(
                spark,
                [
                    "  The  opinion\t審 \r\n\r\n \n\nof  us ",
                    "notes only\n 1234567 1234567 1234567 \nkept line",
                    "Überprofit\n",
                ],
            )
        )
    )
    assert got == ["The opinion\n\nof us", "notes only\nkept line", "berprofit"]


def test_slice_equals_its_steps(spark):
    values = [v + "審計 " + v for v in texts(4)]

    def spec(value):
        ascii_text = "".join(c for c in value if ord(c) < 128)
        kept = spec_blocks(ascii_text, 60) or "\n".join(spec_clean(ascii_text))
        out = []
        for line in lines_with_ends(kept):
            line = re.sub(r"[ \t\x1f]+", " ", line.rstrip("\n\r\x0b\x0c\x1c\x1d\x1e")).rstrip()
            if line or not out or out[-1]:
                out.append(line)
        return "\n".join(out).strip(BLANKS)

    got = results(R.slice_documents(frame(spark, values), min_chars=60))
    for value, result in zip(values, got):
        assert result == spec(value), value


def test_phrase_flags(spark):
    values = {
        "r20240630": "An Unqualified Opinion",
        "r20240631": "an un-qualified\n opinion; disclaimer opinion",
        "x": "DISCLAIMER  OF\r\nOPINION. adverse opinions",
        "y": "going concern alone",
        "z": "Material uncertainty regarding going\x0cconcern and emphasis of matter",
        "empty": "",
    }
    df = spark.createDataFrame(list(values.items()), "document_name string, text string")
    got = {r[0]: tuple(r)[1:] for r in R.phrase_flags(df).collect()}
    assert got == {
        "r20240630": ("2024-06-30", 0, 0, 0, 0, 0),
        "r20240631": ("2024-06-31", 1, 0, 1, 0, 0),
        "x": ("", 0, 0, 1, 0, 0),
        "y": ("", 0, 0, 0, 0, 0),
        "z": ("", 0, 0, 0, 1, 1),
    }
    custom = R.phrase_flags(df, {"upper": r"\bADVERSE\b"}).where("upper = 1").collect()
    assert [r[0] for r in custom] == ["x"]


def test_decoding(spark):
    df = spark.createDataFrame(
        [(1, bytearray("é審".encode())), (2, bytearray("é".encode("latin-1"))), (3, bytearray(b""))],
        "k int, content binary",
    )
    got = {r[0]: r[1] for r in df.select("k", T.decode_text(F.col("content"))).collect()}
    assert got == {1: "é審", 2: "é", 3: ""}
