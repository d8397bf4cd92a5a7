"""Sheets written out cell by cell."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cells
from ledgerloom.operators import grid as G
from ledgerloom.plans import bronze

GRID = "source_file string, row_idx long, cells array<string>"


def sheet(name, *lines):
    return [(name, i, list(line)) for i, line in enumerate(lines)]


@pytest.fixture
def isin_grid(spark):
    return spark.createDataFrame(
        sheet(
            "a",
            ["Title", None, None],
            [None, None, None],
            ["Name", "ISIN", "Code"],
            ["One\r\nLtd", "I1", "00007", '""', "HK", "AG"],
            ["Two", "I2", " 7 "],
            ["Three", '"', "12.5"],
            ["Four", "I4", "x"],
            ["Five", "I5", None],
            [None, "stray", "1"],
            [None, None, None],
            ["Agencies", None, None],
            ["Code", "Description", "No"],
            [" AG ", "Agency\nname", "3"],
            ["nan", "Other", "4"],
            ["Gone", None, "5"],
            ["After", "After", "6"],
        )
        + sheet("empty", ["only", "two"], [None, None]),
        GRID,
    )


def test_first_table(spark, rows, isin_grid):
    got = rows(bronze.isin_list(isin_grid), "company", "isin", "stock_code", "stock_type", "national_agency")
    assert got == [
        ("One Ltd", "I1", 7, None, "AG"),
        ("Three", None, 12, None, None),
        ("Two", "I2", 7, None, None),
    ]


def test_second_table_and_missing_tables(spark, rows, isin_grid):
    got = rows(bronze.isin_list(isin_grid, nth=2), "company", "stock_code")
    assert got == [(" AG ", 3), ("After", 6), ("Gone", 5), ("nan", 4)]
    assert rows(bronze.sheets_without_table(isin_grid), "source_file") == [("empty",)]


def test_legend(spark, rows, isin_grid):
    got = rows(bronze.national_agencies(isin_grid), "national_agency", "description")
    assert got == [(None, "Other"), ("AG", "Agency name")]


def test_growth_board(spark, rows):
    names = ["Date", "Code", None, *[f"c{i}" for i in range(10)], " ", "last"]
    row = lambda first, code: [first, code, "skipped", *[f"v{i}" for i in range(10)], "skipped", "end"]
    filler = [[None]] * 9
    grid = spark.createDataFrame(
        sheet("good", *filler, names, ["ignored"], row("d1\r\n2", " 8001 "), row("d2", "  "), row("d3", None),
              row("d4", "8.9"), row("d5", "n/a"), row(" ToTaL ", "1"), row("d6", "8002"))
        + sheet("short", *filler, names[:12], ["ignored"], row("d1", "8001"))
        + sheet("headless", ["a"]),
        GRID,
    )
    good, bad = bronze.growth_board(grid)
    assert rows(good, "listing_date", "stock_code", "company", "reporting_accountant") == [
        ("d1 2", 8001, "v0", "end"), ("d4", 8, "v0", "end")
    ]
    assert rows(bad, "source_file") == [("headless",), ("short",)]


def test_main_board(spark, rows):
    def line(code, mark, name="N"):
        return ["1", code, name, "p", "l", "s", "r", "v", "10", "1.0", mark]

    grid = spark.createDataFrame(
        sheet("m", ["title"], ["header"], line("5", "(a)", "A   B\nC"), line('"', "(b)"), line('""', "(c)"),
              line(None, "(a)"), line("x", "(a)"), line("6", None))
        + sheet("narrow", ["title"], ["header"], ["1", "5", "N", "p", "l", "s", "r", "v", "10", "(a)"],
                ["1", '"', "N", "p", "l", "s", "r", "v", "10", "(b)"]),
        GRID,
    )
    got = rows(bronze.main_board(grid), "source_file", "row_idx", "stock_code", "company", "offer_location")
    assert got == [
        ("m", 2, 5, "A B C", "(a)"),
        ("m", 3, 5, "N", "(b)"),
        ("m", 4, 5, "N", "(c)"),
        ("m", 7, 6, "N", None),
        ("narrow", 2, 5, "N", None),
    ]


def test_stock_types(spark, rows):
    text = "Types (ORD SH – Ordinary (H) shares; W - Warrant - call; none; )"
    grid = spark.createDataFrame([("a", 16, [text]), ("b", 16, ["X - no brackets"]), ("a", 1, ["(Y - Z)"])], GRID)
    assert rows(bronze.stock_types(grid), "source_file", "stock_type", "description") == [
        ("a", "ORD SH", "Ordinary (H) shares"), ("a", "W", "Warrant - call"), ("b", "X", "no brackets")
    ]


def test_keys(spark):
    values = ["00007", " 7\t", "12.9", "-3.7", "1e3", ".5", "9007199254740993", "7d", "NaN", "Infinity", "", None, "1e30"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(cells.to_key(F.col("v"))).collect()]
    assert got == [7, 7, 12, -3, 1000, 0, 9007199254740993, None, None, None, None, None, None]


def test_union_of_files_with_different_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    assert rows(G.union_files([a, b])) == [(1, "x", None), (2, None, "y")]


def test_cells_are_flattened_once(spark):
    sheets = spark.createDataFrame([(['""', "a\r\n\nb", "", None, '"\n"', "c"],)], "cells array<string>")
    clean = sheets.select(cells.clean_cells(F.col("cells")).alias("cells"))
    assert clean.first().cells == [None, "a b", "", None, '" "', "c"]
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
