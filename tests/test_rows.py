"""Row-order operators: big groups in ranges equal one window per group."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import grid as G
from ledgerloom.operators.neighbours import running_last, with_neighbours
from ledgerloom.operators.silver import merge_offer_rows


def hot_rows(seed, n=400):
    """A third of the rows in one group, the rest in many."""
    rng = random.Random(seed)
    positions = rng.sample(range(5000), n)
    return [
        (rng.choice(["hot"] * 10 + [None] + [f"k{i}" for i in range(19)]), p, rng.choice([None, 1, 2, 3]))
        for p in positions
    ]


@pytest.mark.parametrize("width", [1, 7, 100, 1 << 20])
def test_neighbours(spark, rows, width):
    df = spark.createDataFrame(hot_rows(width), "k string, p int, v int")
    w = Window.partitionBy("k").orderBy("p")
    got = with_neighbours(df, ["k"], ["p"], ["p", "v"], back=2, ahead=2, width=width)
    want = df
    for i in (1, 2):
        want = want.withColumn(f"prev_{i}", F.lag(F.struct("p", "v"), i).over(w))
    for i in (1, 2):
        want = want.withColumn(f"next_{i}", F.lead(F.struct("p", "v"), i).over(w))
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("width", [1, 7, 100, 1 << 20])
def test_running_last(spark, rows, width):
    df = spark.createDataFrame(hot_rows(width + 1), "k string, p int, v int")
    w = Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    got = running_last(df.where("k is not null"), ["k"], ["p"], F.col("v"), "last", width=width)
    want = df.where("k is not null").withColumn("last", F.last("v", True).over(w))
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("width", [1, 20, 1 << 20])
def test_neighbours_over_segments(spark, rows, width):
    data = [(k, f"f{p % 4}", p // 4, v) for k, p, v in hot_rows(width + 2)]
    df = spark.createDataFrame(data, "k string, s string, p int, v int")
    w = Window.partitionBy("k").orderBy("s", "p")
    got = with_neighbours(df, ["k"], ["p"], ["v"], back=1, ahead=1, segments=["s"], width=width)
    want = df.withColumn("prev_1", F.lag(F.struct("v")).over(w)).withColumn("next_1", F.lead(F.struct("v")).over(w))
    assert rows(got, *want.columns) == rows(want)
    last = running_last(df.where("k is not null"), ["k"], ["p"], F.col("v"), "last", ["s"], width)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    assert rows(last) == rows(df.where("k is not null").withColumn("last", F.last("v", True).over(upto)))


def spec_offers(offers):
    """Row by row: each (b)/(c) hands its amount to the row above with its code."""
    out, last = {}, {}
    for code, seq, amount, mark in offers:
        mark = (mark or "").strip()
        if mark in ("(b)", "(c)") and code in last:
            out[last[code]][2 if mark == "(b)" else 3] = amount
            out[seq] = [code, None, None, None, True]
        else:
            own = None if mark in ("(b)", "(c)") else amount
            out[seq] = [code, own, None, None, False]
        last[code] = seq
    return sorted((seq, *row[:4]) for seq, row in out.items() if not row[4])


@pytest.mark.parametrize("width", [1, 5, 1 << 20])
def test_offers(spark, width):
    rng = random.Random(width)
    offers = [
        (rng.choice([1, 1, 1, 2, 3, 4]), seq, float(seq), rng.choice(["(a)", " (b)", "(c) ", None, "x"]))
        for seq in range(300)
    ]
    df = spark.createDataFrame(offers, "stock_code int, seq int, funds_raised double, offer_location string")
    got = merge_offer_rows(df, ["seq"], width=width).select(
        "seq", "stock_code", "funds_raised_hk", "funds_raised_intl", "funds_raised_sg"
    )
    assert sorted(tuple(r) for r in got.collect()) == spec_offers(offers)


def test_offer_cases(spark):
    offers = [
        (1, 0, 10.0, "(a)"), (1, 1, 20.0, "(b)"), (1, 2, 30.0, "(c)"),  # the (c) amount is lost
        (2, 3, 40.0, "(b)"),                                           # orphan stays, unpaid
        (3, 4, 50.0, "(a)"), (3, 5, 60.0, "(c)"),
    ]
    df = spark.createDataFrame(offers, "stock_code int, seq int, funds_raised double, offer_location string")
    got = merge_offer_rows(df, ["seq"]).select(
        "seq", "funds_raised_hk", "funds_raised_intl", "funds_raised_sg"
    )
    assert sorted(tuple(r) for r in got.collect()) == [
        (0, 10.0, 20.0, None), (3, None, None, None), (4, 50.0, None, 60.0)
    ]


def spec_keys(sheet):
    """Row by row, looking at keys as already filled."""
    filled = []
    for i, (key, mark) in enumerate(sheet):
        mark = (mark or "").strip()
        above = (sheet[i - 1][1] or "").strip() if i else ""
        if mark in ("(b)", "(c)") and above == "(a)":
            key = filled[i - 1]
        elif mark == "(c)" and above == "(b)" and i > 1:
            key = filled[i - 2]
        filled.append(key)
    return filled


@pytest.mark.parametrize("width", [1, 3, 10, 1 << 20])
def test_continuation_keys(spark, width):
    rng = random.Random(width)
    marks = ["(a)", "(b)", "(c)", "(b)", "(c)", " (c) ", None]
    sheets = {
        f"f{n}": [(rng.choice([None, f"{n}{i}"]), rng.choice(marks)) for i in range(size)]
        for n, size in enumerate([1, 2, 3, 40, 250])
    }
    data = [
        (name, i * 3, key, mark) for name, sheet in sheets.items() for i, (key, mark) in enumerate(sheet)
    ]
    df = spark.createDataFrame(data, "source_file string, row_idx long, code string, mark string")
    got = G.fill_continuation_keys(df, "code", "mark", ["source_file"], ["row_idx"], width)
    found = {}
    for r in got.orderBy("source_file", "row_idx").collect():
        found.setdefault(r["source_file"], []).append(r["code"])
    assert found == {name: spec_keys(sheet) for name, sheet in sheets.items()}
