"""Landed sheets to clean listing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cells import cell, squeeze_spaces, strip
from ledgerloom.operators import grid as G
from ledgerloom.operators.joins import left_lookup
from ledgerloom.session import settle

# Column names of the clean tables, in sheet order.
MAIN_COLUMNS = (
    "stock_code", "company", "prospectus_date", "listing_date", "sponsors",
    "reporting_accountant", "valuers", "funds_raised", "subscription_price", "offer_location",
)
GEM_COLUMNS = (
    "listing_date", "stock_code", "company", "offer_price", "subscription_ratio",
    "funds_raised", "shrout_at_listing", "mcap_at_listing", "industry",
    "place_of_incorporation", "listing_method", "sponsors", "reporting_accountant",
)
ISIN_COLUMNS = (
    "company", "isin", "stock_code", "stock_type", "place_of_incorporation", "national_agency",
)
NAME_COLUMNS = ("stock_code", "hkex_co_name")
AGENCY_COLUMNS = ("national_agency", "description")

# Sheet layout.
MAIN_FIRST_ROW = 2
MAIN_SHEET_CELLS = 11
GEM_HEADER_ROW, GEM_FIRST_ROW = 9, 11
LEGEND_ROW = 16


def main_board(grid: DataFrame) -> DataFrame:
    """Main board offers: keys filled down over continuation rows, then coerced.

    The first sheet column is a counter and goes. Sheets too narrow to have the
    offer column are not filled.
    """
    rows = grid.where(F.col("row_idx") >= MAIN_FIRST_ROW)
    has_key = cell(F.col("cells"), 1).isNotNull()
    # One pass over the sheets before the one that reads their rows.
    sheets = settle(
        rows.groupBy("source_file").agg(
            F.max(F.size("cells")).alias("_cells"), F.count_if(has_key).alias("_rows")
        ),
        "main-sheets",
    )
    narrow = sheets.where(F.col("_cells") < MAIN_SHEET_CELLS).select("source_file", "_cells")
    # Rows without a key go before quote-only cells are blanked: a ditto mark is a key to fill.
    keyed = rows.where(has_key)
    offers = keyed.withColumn("cells", F.slice("cells", 2, len(MAIN_COLUMNS)))
    clean = G.name_columns(G.normalize_cells(offers), MAIN_COLUMNS).withColumn(
        "company", squeeze_spaces(F.col("company"))
    )
    marked = left_lookup(clean, narrow, [("source_file", "source_file")], branch=False).withColumn(
        "_mark", F.when(F.col("_cells").isNull(), F.col("offer_location"))
    )
    filled = G.fill_continuation_keys(
        marked.drop("_cells"), "stock_code", "_mark", ["source_file"], ["row_idx"],
        sizes=sheets.select("source_file", "_rows"),
    )
    return G.coerce_key(filled.drop("_mark"), "stock_code")


def growth_board(grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Growth board offers, and the files whose header lacks columns."""
    flat = G.normalize_cells(grid, quotes=False)
    region, rejects = G.fixed_header_region(
        flat, GEM_HEADER_ROW, GEM_FIRST_ROW, len(GEM_COLUMNS)
    )
    rows = G.cut_at_marker(G.name_columns(region, GEM_COLUMNS), GEM_COLUMNS[0], "total")
    return G.coerce_key(G.drop_blank(rows, "stock_code"), "stock_code"), rejects


def isin_list(grid: DataFrame, nth: int = 1) -> DataFrame:
    """Identifier list from the ``nth`` table of each sheet."""
    region = G.normalize_cells(G.table_region(grid, min_cells=3, nth=nth))
    return G.coerce_key(G.name_columns(region, ISIN_COLUMNS), "stock_code")


def short_names(grid: DataFrame) -> DataFrame:
    region = G.normalize_cells(G.table_region(grid, min_cells=2))
    return G.coerce_key(G.name_columns(region, NAME_COLUMNS), "stock_code")


def _rejected(bounds: DataFrame, reasons: dict[str, str]) -> DataFrame:
    """``source_file, reason`` by the first bound that is missing."""
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(text)) for c, text in reasons.items()])
    return bounds.select("source_file", reason.alias("reason")).where(F.col("reason").isNotNull())


def sheets_without_table(grid: DataFrame, min_cells: int = 3, nth: int = 1) -> DataFrame:
    """Files where the ``nth`` table, or a bound it depends on, is missing."""
    reasons = {"header_1": "table 1 not found"}
    for i in range(2, nth + 1):
        reasons[f"stop_{i - 1}"] = f"table {i - 1} has no end"
        reasons[f"header_{i}"] = f"table {i} not found"
    return _rejected(G.table_bounds(grid, min_cells, nth), reasons)


def sheets_without_legend(grid: DataFrame) -> DataFrame:
    """Files without the agency table below the main one."""
    return _rejected(
        G.legend_bounds(grid),
        {
            "header_1": "table 1 not found", "stop_1": "table 1 has no end",
            "legend_header": "agency table not found",
        },
    )


def sheets_without_offers(grid: DataFrame) -> DataFrame:
    """Main board files in which no row has a key."""
    keyed = (F.col("row_idx") >= MAIN_FIRST_ROW) & cell(F.col("cells"), 1).isNotNull()
    return grid.groupBy("source_file").agg(F.count_if(keyed).alias("_n")).where("_n = 0").select(
        "source_file", F.lit("no row with a key").alias("reason")
    )


def sheet_rejects(
    main: DataFrame, gem: DataFrame, agency: DataFrame, exchange: DataFrame, names: DataFrame
) -> DataFrame:
    """``sheet, source_file, reason``: files of all kinds that give no table, or not all."""
    found = {
        "main": sheets_without_offers(main),
        "gem": growth_board(gem)[1],
        "agency": sheets_without_table(agency),
        "agency legend": sheets_without_legend(agency),
        "exchange": sheets_without_table(exchange, nth=2),
        "names": sheets_without_table(names, min_cells=2),
    }
    frames = [df.select(F.lit(kind).alias("sheet"), "source_file", "reason") for kind, df in found.items()]
    return G.union_files(frames)


def national_agencies(grid: DataFrame) -> DataFrame:
    region = G.normalize_cells(G.legend_region(grid), quotes=False)
    rows = G.name_columns(region, AGENCY_COLUMNS)
    return rows.withColumns(
        {n: F.when(strip(F.col(n)) != "nan", strip(F.col(n))) for n in AGENCY_COLUMNS}
    )


def stock_types(grid: DataFrame, row: int = LEGEND_ROW) -> DataFrame:
    """Type codes listed in the first cell of one sheet row."""
    text = grid.where(F.col("row_idx") == row).select(
        "source_file", cell(F.col("cells"), 0).alias("legend")
    )
    return G.parse_legend(text, "legend")
