"""Tables inside landed sheets.

A grid is ``source_file STRING, row_idx BIGINT, cells ARRAY<STRING>``: one row
per sheet row, the order in ``row_idx``. One sheet may hold a large share of
all rows, so the bounds of its tables come from per-file minima, which combine
before the shuffle, and never from a window over the file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cells import cell, clean_cells, filled_cells, strip, to_key
from ledgerloom.operators.joins import spread_join
from ledgerloom.operators.neighbours import WIDTH, cut_groups, running_last, with_neighbours
from ledgerloom.session import settle

FILE = "source_file"
ROW = "row_idx"


def normalize_cells(grid: DataFrame, quotes: bool = True) -> DataFrame:
    return grid.withColumn("cells", clean_cells(F.col("cells"), quotes))


def row_marks(grid: DataFrame) -> DataFrame:
    """What bounds are found by, a few bytes a row, read from the sheets once.

    ``filled`` counts the filled cells; ``blank`` and ``open`` say that the first
    and the second cell are empty.
    """
    marks = grid.select(
        FILE, ROW,
        filled_cells(F.col("cells")).alias("filled"),
        cell(F.col("cells"), 0).isNull().alias("blank"),
        cell(F.col("cells"), 1).isNull().alias("open"),
    )
    return settle(marks, "row-marks")


def _first_row(marks: DataFrame, found: Column, name: str) -> DataFrame:
    """Per file the first row that is ``found``; NULL when there is none."""
    first = marks.groupBy(FILE).agg(F.min(F.when(found, F.col(ROW))).alias(name))
    return settle(first, name)


def _next_row(
    marks: DataFrame, bounds: DataFrame, after: str, found: Column, name: str
) -> DataFrame:
    """Extend per-file ``bounds`` with the first row behind ``after`` that is ``found``."""
    hit = F.when(found & (F.col(ROW) > F.col(after)), F.col(ROW))
    joined = spread_join(marks, bounds, [(FILE, FILE)], "inner")
    extended = joined.groupBy(*bounds.columns).agg(F.min(hit).alias(name))
    return settle(extended, name)


def table_bounds(
    grid: DataFrame, min_cells: int = 3, nth: int = 1, marks: DataFrame | None = None
) -> DataFrame:
    """Per file ``header_1, stop_1, … header_n, stop_n``.

    A header is the first row with ``min_cells`` filled cells; a table stops at
    the first later row whose first cell is empty. A bound not found is NULL.
    All of them come from ``marks``, those of the grid unless given.
    """
    marks = row_marks(grid) if marks is None else marks
    heads = F.col("filled") >= min_cells
    bounds = _first_row(marks, heads, "header_1")
    for i in range(1, nth + 1):
        if i > 1:
            bounds = _next_row(marks, bounds, f"stop_{i - 1}", heads, f"header_{i}")
        bounds = _next_row(marks, bounds, f"header_{i}", F.col("blank"), f"stop_{i}")
    return bounds


def _between(grid: DataFrame, bounds: DataFrame, header: str, stop: str) -> DataFrame:
    row = F.col(ROW)
    inside = (row > F.col(header)) & (F.col(stop).isNull() | (row < F.col(stop)))
    bounded = spread_join(grid, bounds.select(FILE, header, stop), [(FILE, FILE)], "inner")
    return bounded.where(inside).select(*grid.columns)


def table_region(grid: DataFrame, min_cells: int = 3, nth: int = 1) -> DataFrame:
    """The data rows of the ``nth`` table of every file, without its header."""
    bounds = table_bounds(grid, min_cells, nth)
    return _between(grid, bounds, f"header_{nth}", f"stop_{nth}")


def legend_bounds(grid: DataFrame, min_cells: int = 3) -> DataFrame:
    """Per file the rows of the legend: ``header_1, stop_1, title, legend_header, legend_stop``.

    Below the main table come blank rows, a title row and a header row; the
    legend runs until its second cell is empty.
    """
    marks = row_marks(grid)
    bounds = table_bounds(grid, min_cells, marks=marks)
    bounds = _next_row(marks, bounds, "stop_1", F.col("filled") > 0, "title")
    bounds = _next_row(marks, bounds, "title", F.lit(True), "legend_header")
    return _next_row(marks, bounds, "legend_header", F.col("open"), "legend_stop")


def legend_region(grid: DataFrame, min_cells: int = 3) -> DataFrame:
    """The two-column table below the main table."""
    return _between(grid, legend_bounds(grid, min_cells), "legend_header", "legend_stop")


def cut_at_marker(df: DataFrame, column: str, marker: str) -> DataFrame:
    """Keep each file's rows above the first whose ``column`` is ``marker`` (any case)."""
    marks = df.select(FILE, ROW, (F.lower(strip(F.col(column))) == marker.lower()).alias("hit"))
    cut = _first_row(marks.where("hit"), F.col("hit"), "cut").withColumnRenamed("cut", "_cut")
    return (
        spread_join(df, cut, [(FILE, FILE)], "left", branch=False)
        .where(F.col("_cut").isNull() | (F.col(ROW) < F.col("_cut")))
        .drop("_cut")
    )


def fixed_header_columns(grid: DataFrame, header_row: int = 9) -> DataFrame:
    """Per file ``positions``: indexes of the cells with a column name in the header row."""
    header = F.transform(F.col("cells"), strip)
    named = F.filter(
        F.transform(header, lambda c, i: F.when((c != "") & (F.lower(c) != "nan"), i)),
        lambda i: i.isNotNull(),
    )
    columns = grid.where(F.col(ROW) == header_row).select(FILE, named.alias("positions"))
    return settle(columns, "header")


def fixed_header_region(
    grid: DataFrame, header_row: int = 9, data_row: int = 11, n_cols: int = 13
) -> tuple[DataFrame, DataFrame]:
    """Data rows of sheets with a fixed header row, cut to their named columns.

    Files with fewer than ``n_cols`` named columns give no rows; the second
    frame lists them.
    """
    columns = fixed_header_columns(grid, header_row).where(F.size("positions") >= n_cols)
    picked = F.transform(
        F.slice("positions", 1, n_cols), lambda i: F.get(F.col("cells"), i)
    )
    region = (
        spread_join(grid.where(F.col(ROW) >= data_row), columns, [(FILE, FILE)], "inner")
        .withColumn("cells", picked)
        .select(*grid.columns)
    )
    bad = grid.select(FILE).distinct().join(columns, FILE, "left_anti")
    reason = F.lit(f"fewer than {n_cols} named columns").alias("reason")
    return region, bad.select(FILE, reason)


def name_columns(grid: DataFrame, names, keep=(FILE, ROW)) -> DataFrame:
    """One column per name from the leading cells; missing cells are NULL."""
    return grid.select(*keep, *[cell(F.col("cells"), i).alias(n) for i, n in enumerate(names)])


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(strip(F.col(column)) != "")


def coerce_key(df: DataFrame, column: str) -> DataFrame:
    """Make the key a BIGINT and drop the rows where it is not a number."""
    return df.withColumn(column, to_key(F.col(column))).where(F.col(column).isNotNull())


def fill_continuation_keys(
    df: DataFrame,
    key: str,
    marker: str,
    groups: list[str],
    order: list[str],
    width: int = WIDTH,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Give (b)/(c) rows the key of the offer they continue.

    A (b) or (c) right after an (a) takes that row's key; a (c) right after a
    (b) takes the key two rows up, as it stands after its own fill. A chain of
    such steps runs …, (b), (c), (b), (c), so its root is the last row before
    it that starts a chain.
    """
    mark = F.coalesce(strip(F.col(marker)), F.lit(""))
    marked = df.withColumns({"_mark": mark, "_key": F.struct(F.col(key).alias("key"))})
    cut = cut_groups(marked, groups, order, [], width, sizes)
    near = with_neighbours(cut, groups, order, ["_mark", "_key"], back=2, ahead=2)

    before = F.coalesce(F.col("prev_1._mark"), F.lit(""))
    after_a = F.col("_mark").isin("(b)", "(c)") & (before == "(a)")
    chained = (F.col("_mark") == "(c)") & (before == "(b)") & F.col("prev_2").isNotNull()
    # This row begins a chain when the row two below is chained to it.
    roots = (
        ~chained
        & (F.coalesce(F.col("next_1._mark"), F.lit("")) == "(b)")
        & (F.coalesce(F.col("next_2._mark"), F.lit("")) == "(c)")
    )
    own = F.when(after_a, F.col("prev_1._key")).otherwise(F.col("_key"))
    flagged = near.withColumns({"_own": own, "_chained": chained, "_roots": roots}).drop(
        "prev_1", "prev_2", "next_1", "next_2"
    )
    rooted = running_last(flagged, groups, order, F.when(F.col("_roots"), F.col("_own")), "_root")
    filled = F.when(F.col("_chained"), F.col("_root.key")).otherwise(F.col("_own.key"))
    return rooted.withColumn(key, filled).select(*df.columns)


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Append frames whose column sets may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def parse_legend(
    df: DataFrame, column: str, names=("stock_type", "description"),
    item_sep: str = ";", pair_sep: str = " - ",
) -> DataFrame:
    """``code - description; …`` inside the outermost brackets to one row per entry.

    Text without brackets is read whole; entries without the separator go.
    """
    text = strip(F.col(column))
    inner = F.regexp_extract(text, r"(?s)\((.*)\)", 1)
    body = F.when(text.rlike(r"(?s)\(.*\)"), inner).otherwise(text)
    body = F.regexp_replace(body, " – ", " - ")
    others = [c for c in df.columns if c != column]
    entries = df.select(
        *others, F.posexplode(F.split(body, f"[{item_sep}]")).alias("position", "_entry")
    ).withColumn("_entry", strip(F.col("_entry")))
    pair = F.split(F.col("_entry"), pair_sep, 2)
    return entries.where(F.contains("_entry", F.lit(pair_sep))).select(
        *others, "position",
        strip(F.get(pair, F.lit(0))).alias(names[0]),
        strip(F.get(pair, F.lit(1))).alias(names[1]),
    )
