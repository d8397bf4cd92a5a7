"""From landed inputs to the tables, views and exports of one run.

Each step is a plan over the ones before. Steps that several others read are
settled once, since a plan read twice would run twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.operators import worklist as W
from ledgerloom.operators.joins import join_master
from ledgerloom.operators.reports import flag_paths
from ledgerloom.operators.silver import build_isin_master, merge_offer_rows
from ledgerloom.plans import bronze, views
from ledgerloom.session import settle
from ledgerloom.sources.files import fundamentals, restrict_to_keys


def isin_table(agency: DataFrame, exchange: DataFrame, names: DataFrame) -> DataFrame:
    """The identifier master from the grids of both lists and the short names."""
    place = ("source_file", "row_idx")
    master = build_isin_master(
        bronze.isin_list(agency).drop(*place),
        bronze.isin_list(exchange, nth=2).drop(*place),
        bronze.short_names(names).drop(*place),
    )
    return settle(master, "isin-master")


def main_table(grid: DataFrame, master: DataFrame) -> DataFrame:
    """Main board offers, merged and joined to the identifier master."""
    offers = settle(bronze.main_board(grid), "main-board")
    merged = merge_offer_rows(offers, ["row_idx"], segments=["source_file"])
    return join_master(merged.drop("row_idx"), master, "stock_code")


def gem_table(grid: DataFrame, master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Growth board offers joined to the identifier master, and the rejected files."""
    rows, rejects = bronze.growth_board(grid)
    return join_master(rows.drop("row_idx"), master, "stock_code"), rejects


def listing_tables(
    main: DataFrame, gem: DataFrame, agency: DataFrame, exchange: DataFrame, names: DataFrame
) -> dict[str, DataFrame]:
    """Listing tables from the grids of the five kinds of sheet."""
    master = isin_table(agency, exchange, names)
    growth, _ = gem_table(gem, master)
    return {
        "hkex_main": main_table(main, master),
        "hkex_gem": growth,
        "hkex_isin": master,
        "desc_hkex_stock_types": bronze.stock_types(agency).drop("source_file", "position"),
        "desc_hkex_national_agencies": bronze.national_agencies(agency).drop("source_file", "row_idx"),
        "rejected_files": bronze.sheet_rejects(main, gem, agency, exchange, names),
    }


def fundamentals_tables(
    annual: DataFrame, quarterly: DataFrame, isins: DataFrame
) -> dict[str, DataFrame]:
    """The exchange pulls, and the pulls for a list of ISINs."""
    exchange = views.EXCHANGE | views.INDUSTRIAL
    return {
        "funda_a_170": fundamentals(annual, exchange, views.ANNUAL_COLUMNS),
        "funda_q_170": fundamentals(quarterly, exchange, views.QUARTER_COLUMNS),
        "funda_a_isin": restrict_to_keys(
            fundamentals(annual, views.INDUSTRIAL, views.ANNUAL_COLUMNS), isins, "isin"
        ),
        "funda_q_isin": restrict_to_keys(
            fundamentals(quarterly, views.INDUSTRIAL, None), isins, "isin"
        ),
    }


def document_tables(index: DataFrame, texts: DataFrame, done: DataFrame | None = None) -> dict[str, DataFrame]:
    """The report index and the flags of its documents, earlier flags first."""
    paths = W.document_worklist(index)
    if done is None:
        flags = flag_paths(paths, texts)
    else:
        fresh = flag_paths(W.skip_done(paths, done, "pdf_path", "document_name"), texts)
        flags = done.unionByName(fresh)
    return {"hkex_auditor_reports": index, "auditor_opinion_flags": flags}


def build(
    listings: dict[str, DataFrame], annual: DataFrame, quarterly: DataFrame,
    index: DataFrame, texts: DataFrame, done: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All tables and views of one run from the listing tables and the other inputs."""
    boards = [listings["hkex_main"], listings["hkex_gem"], listings["hkex_isin"]]
    tables = {
        **listings,
        **fundamentals_tables(annual, quarterly, views.isin_keys(boards)),
        **document_tables(index, texts, done),
    }
    return {**tables, **views.views(tables)}
