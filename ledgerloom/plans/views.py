"""The relational views: entity master, datasets, reconciliations and exports.

Inputs are DataFrames named after the tables they stand for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cells import key_column
from ledgerloom.functions.codes import on_or_after
from ledgerloom.operators import joins as J
from ledgerloom.operators.latest import latest_rows, one_per_group
from ledgerloom.operators.sets import entity_master, ordinary_shares, union_distinct
from ledgerloom.session import settle

# First year and date of the datasets, and fundamentals filters.
FIRST_YEAR = 2014
FIRST_DATE = "2014-01-01"
EXCHANGE = {"exchg": 170}
INDUSTRIAL = {"indfmt": "INDL", "popsrc": "I", "consol": "C", "datafmt": "HIST_STD"}
ANNUAL_COLUMNS = ["gvkey", "isin", "conm", "datadate", "fyear"]
QUARTER_COLUMNS = [
    "gvkey", "isin", "conm", "datadate", "datacqtr", "datafqtr", "fyearq", "fqtr",
]

# Listing columns taken from either board, the growth board first,
# and those of one board only.
SHARED_LISTING_COLUMNS = (
    "source_file", "stock_code", "company", "listing_date", "sponsors",
    "reporting_accountant", "company_isino", "isin", "stock_type",
    "place_of_incorporation", "national_agency", "hkex_co_name",
)
GEM_LISTING_COLUMNS = (
    "offer_price", "subscription_ratio", "funds_raised", "shrout_at_listing",
    "mcap_at_listing", "industry", "listing_method", "place_of_incorporation_isino",
)
MAIN_LISTING_COLUMNS = (
    "prospectus_date", "valuers", "subscription_price",
    "funds_raised_hk", "funds_raised_intl", "funds_raised_sg",
)
OPINION_COLUMNS = (
    "aof_qualified_op", "aof_adverse_op", "aof_disclaimer_op", "aof_emphasis_op",
    "aof_material_unc_op",
)


def firm_dataset(funda_q: DataFrame, master: DataFrame) -> DataFrame:
    """Firm-quarters with their listing; a firm with several codes repeats."""
    listing = master.select(
        F.col("isin").alias("_isin"),
        F.col("stock_code").alias("hkex_stock_code"),
        F.col("stock_type").alias("hkex_stock_type"),
        F.col("company").alias("hkex_full_name"),
    )
    joined = J.left_lookup(funda_q.select(*QUARTER_COLUMNS), listing, [("isin", "_isin")])
    return joined.select(
        "hkex_stock_code", "hkex_stock_type", "hkex_full_name",
        *[F.col(c).alias(f"cs_{c}") for c in QUARTER_COLUMNS],
    )


def document_dataset(flags: DataFrame, index: DataFrame, master: DataFrame) -> DataFrame:
    """Opinion flags with their report index row and listing."""
    reports = index.select(
        F.col("document_name").alias("_name"),
        F.col("stock_code").alias("har_stock_code"),
        F.col("announcement_date").alias("har_announcement_date"),
        F.col("hyperlink").alias("har_hyperlink"),
        F.col("pdf_path").alias("har_pdf_path"),
    )
    listing = master.select(
        F.col("stock_code").alias("_code"),
        F.col("stock_type").alias("hkex_stock_type"),
        F.col("company").alias("hkex_full_name"),
    )
    # The index meets the listings first, so that no join is below another's left side.
    listed = J.left_lookup(reports, listing, [("har_stock_code", "_code")])
    return J.left_lookup(flags, listed, [("document_name", "_name")]).select(
        "har_stock_code", "har_announcement_date", "har_hyperlink", "har_pdf_path",
        "hkex_stock_type", "hkex_full_name",
        F.col("document_name").alias("aof_document_id"),
        F.col("report_date").alias("aof_report_date"),
        F.col("qualified_opinion").alias("aof_qualified_op"),
        F.col("adverse_opinion").alias("aof_adverse_op"),
        F.col("disclaimer_of_opinion").alias("aof_disclaimer_op"),
        F.col("emphasis_of_matter").alias("aof_emphasis_op"),
        F.col("going_concern").alias("aof_material_unc_op"),
    )


def recent_dataset(dataset: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    return dataset.where(F.col("cs_fyearq") >= first_year)


def recent_documents(
    documents: DataFrame, first_date: str = FIRST_DATE, formats: tuple[str, ...] = ()
) -> DataFrame:
    return documents.where(on_or_after(F.col("aof_report_date"), first_date, formats))


def dataset_with_documents(
    dataset: DataFrame, documents: DataFrame, first_year: int = FIRST_YEAR,
    first_date: str = FIRST_DATE, formats: tuple[str, ...] = (),
) -> DataFrame:
    """Dataset rows from ``first_year`` on whose code has a document from ``first_date`` on."""
    recent = F.coalesce(
        on_or_after(F.col("har_announcement_date"), first_date, formats), F.lit(False)
    ) | F.coalesce(on_or_after(F.col("aof_report_date"), first_date, formats), F.lit(False))
    return J.semi_join_where(
        dataset, documents, ("hkex_stock_code", "har_stock_code"),
        F.col("cs_fyearq") >= first_year, recent,
    )


def classified_firm_quarters(
    funda_q: DataFrame, classified: DataFrame, gem: DataFrame, main: DataFrame,
    comments: str = "Unnamed: 16",
) -> DataFrame:
    """One row per firm and quarter with the year-end opinion and the latest listing.

    Fundamentals and opinions are each cut to one row per firm and quarter
    before they meet, which picks the same pair as cutting their join would
    (the order compares the fundamentals row first) without its fan-out. The
    listings are cut to the latest before they meet anything, and join last, for the
    quarters with a code alone.
    """
    firm_cols = funda_q.columns
    quarters = one_per_group(
        funda_q.withColumn("_firm", key_column(funda_q, "gvkey")),
        ["gvkey", "datacqtr", "_firm"],  # a firm's number follows from its gvkey
        [F.col("datadate").desc(), "isin", *[c for c in firm_cols if c not in ("datadate", "isin")]],
    )
    opinion_cols = ["hkex_stock_code", *OPINION_COLUMNS, "aof_comments"]
    year_end = classified.where(F.col("cs_fqtr") == 4).select(
        key_column(classified, "cs_gvkey").alias("_gvkey"),
        F.col("cs_datacqtr").alias("_quarter"),
        "hkex_stock_code", *OPINION_COLUMNS,
        F.col(f"`{comments}`").alias("aof_comments"),
    )
    opinions = one_per_group(year_end, ["_gvkey", "_quarter"], opinion_cols)
    keyed = opinions.where(F.col("_gvkey").isNotNull() & F.col("_quarter").isNotNull())

    def board(df: DataFrame, prefix: str, columns) -> DataFrame:
        return df.select(
            F.col("stock_code").alias(f"_{prefix}_code"),
            F.col("listing_date").alias(f"_{prefix}_by"),
            *[F.col(c).alias(f"_{prefix}_{c}") for c in (*SHARED_LISTING_COLUMNS, *columns)],
        )

    keyed = settle(keyed, "opinions")  # read for their codes and for the quarters
    # What is wide is looked up once per code, and moves once per quarter with an opinion.
    listed = keyed.select(F.col("hkex_stock_code").alias("_code")).where(F.col("_code").isNotNull()).distinct()
    for prefix, df, columns in (
        ("gem", gem, GEM_LISTING_COLUMNS), ("main", main, MAIN_LISTING_COLUMNS)
    ):
        last = latest_rows(board(df, prefix, columns), f"_{prefix}_code", f"_{prefix}_by")
        listed = J.left_lookup(listed, last, [("_code", f"_{prefix}_code")], branch=False)
    listed = settle(listed, "listings")
    # Quarters without a key are few, and the window is not to run twice.
    found = J.left_lookup(quarters, keyed, [("_firm", "_gvkey"), ("datacqtr", "_quarter")], branch=False)
    found = settle(found.select(*firm_cols, *opinion_cols), "firm-quarters")
    found = J.left_lookup(found, listed, [("hkex_stock_code", "_code")])
    return found.select(
        *firm_cols,
        *opinion_cols,
        *[F.coalesce(f"_gem_{c}", f"_main_{c}").alias(f"hk_{c}") for c in SHARED_LISTING_COLUMNS],
        *[F.col(f"_gem_{c}").alias(f"gem_{c}") for c in GEM_LISTING_COLUMNS],
        *[F.col(f"_main_{c}").alias(f"main_{c}") for c in MAIN_LISTING_COLUMNS],
    ).orderBy("gvkey", "datadate")


def unmatched_firms(funda_q: DataFrame, master: DataFrame) -> DataFrame:
    return J.unmatched_rows(funda_q, master, "isin", ["gvkey", "isin", "conm"])


def unmatched_listings(master: DataFrame, funda_q: DataFrame) -> DataFrame:
    return J.unmatched_rows(master, funda_q, "isin", ["stock_code", "isin", "company", "stock_type"])


def isin_keys(sources: list[DataFrame]) -> DataFrame:
    return union_distinct([ordinary_shares(s) for s in sources], "isin")


def stock_code_keys(sources: list[DataFrame]) -> DataFrame:
    return union_distinct([ordinary_shares(s) for s in sources], "stock_code")


def reconciliation(funda_a: DataFrame, main: DataFrame) -> dict[str, DataFrame]:
    """The match checks between annual fundamentals and the main board, by name."""
    matched = J.semi_join(funda_a, main, "isin")
    missing_left = J.unmatched_rows(funda_a, main, "isin")
    missing_right = J.unmatched_rows(main, funda_a, "isin")
    return {
        "matched_firms": matched_firms(funda_a, main),
        "totals": J.count_distinct(
            funda_a, {"total_unique_isins": "isin", "total_unique_gvkeys": "gvkey"}
        ),
        "matched": J.count_distinct(
            matched, {"matched_unique_isins": "isin", "matched_unique_gvkeys": "gvkey"}
        ),
        "missing_left_rows": missing_left,
        "missing_left_keys": missing_left.select("gvkey", "isin").distinct(),
        "missing_left": J.count_distinct(
            missing_left, {"missing_isins": "isin", "missing_gvkeys": "gvkey"}
        ),
        "missing_right_rows": missing_right,
        "missing_right_keys": missing_right.select("isin").distinct(),
        "missing_right": J.count_distinct(missing_right, {"missing_isins": "isin"}),
    }


def matched_firms(funda_a: DataFrame, main: DataFrame) -> DataFrame:
    """One matched row per firm: its first fundamentals row with the first listing.

    Listings are cut to one per ISIN and fundamentals to one matched row per
    firm before they join; both orders are total over all columns.
    """
    rows = one_per_group(
        J.semi_join(funda_a, main, "isin"), ["gvkey"],
        ["isin", *[c for c in funda_a.columns if c not in ("gvkey", "isin")]],
    ).select(*funda_a.columns)
    listings = one_per_group(
        main.where(F.col("isin").isNotNull()), ["isin"],
        [c for c in main.columns if c != "isin"],
    )
    return J.match_rows(rows, listings, "isin", "_hkex")


def export_set(
    dataset: DataFrame, documents: DataFrame, isin_master: DataFrame,
    firms_alone: DataFrame, listings_alone: DataFrame,
    first_year: int = FIRST_YEAR, first_date: str = FIRST_DATE,
) -> dict[str, DataFrame]:
    """The six result tables by export name."""
    return {
        "select_hkex_dataset": recent_dataset(dataset, first_year),
        "select_hkex_document_dataset": recent_documents(documents, first_date),
        "select_hkex_dataset_hkex_document_exists": dataset_with_documents(
            dataset, documents, first_year, first_date
        ),
        "select_hkex_isin": isin_master,
        "select_non_match_funda_q_170": firms_alone,
        "select_non_match_hkex_isin": listings_alone,
    }


def views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All views from the base tables, in the order they depend on each other.

    Four of them read the entity master, so it is settled.
    """
    boards = [tables["hkex_main"], tables["hkex_gem"], tables["hkex_isin"]]
    master = settle(entity_master(boards), "entity-master")
    return {
        "hkex_all_stock_code_isin": master,
        "hkex_dataset": firm_dataset(tables["funda_q_isin"], master),
        "hkex_document_dataset": document_dataset(
            tables["auditor_opinion_flags"], tables["hkex_auditor_reports"], master
        ),
        "non_match_funda_q_170": unmatched_firms(tables["funda_q_170"], master),
        "non_match_hkex_isin": unmatched_listings(master, tables["funda_q_170"]),
    }
