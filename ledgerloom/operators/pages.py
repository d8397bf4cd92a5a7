"""Report pages and web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.cells import BLANKS, strip
from ledgerloom.functions.markup import decode_entities, element_bodies, first_element, link_addresses
from ledgerloom.functions.names import base_name, drop_query, split_stem
from ledgerloom.operators.joins import left_lookup
from ledgerloom.session import settle

# Phrases that drop a page, and phrases that keep it all the same.
SKIP_PHRASES = (
    "consolidated statement",
    "statement of profit or loss",
    "statement of financial position",
    "balance sheet",
    "statement of changes in equity",
    "statement of cash flows",
    "cash flow statement",
    "notes to the consolidated financial statements",
    "notes to the financial statements",
)
KEEP_PHRASES = (
    "opinion",
    "auditor",
    "auditors",
    "independent auditor",
    "report on the",
    "basis for opinion",
    "material uncertainty",
    "going concern",
    "emphasis of matter",
)
# Characters after which a document's text goes on in its next part.
PART_CHARS = 64 * 1024 * 1024


def _any_phrase(text: Column, phrases) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(text, F.lit(phrase))
    return found


def filter_pages(pages: DataFrame, skip=SKIP_PHRASES, keep=KEEP_PHRASES) -> DataFrame:
    """Drop the pages with a skip phrase and no keep phrase."""
    lower = F.lower("text")
    return pages.where(~(_any_phrase(lower, skip) & ~_any_phrase(lower, keep)))


def page_totals(pages: DataFrame) -> DataFrame:
    """Pages per document and the length of their text joined by line ends."""
    return pages.groupBy("document_name").agg(
        F.count("*").alias("pages"),
        (F.sum(F.length("text")) + F.count("*") - 1).cast("bigint").alias("text_len"),
    )


def join_pages(pages: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """``document_name, part, text``: the pages of every document joined by line ends.

    A page belongs to the part in which its text begins, counted from the start
    of the document, so that a part is about ``part_chars`` long, or one longer
    page. Joined by line ends in order of ``part``, the parts are the document.
    Where the pages begin is worked out from their lengths; texts shuffle once,
    by document and part.
    """
    sizes = pages.select(
        "document_name", "page_no", (F.coalesce(F.length("text"), F.lit(0)) + 1).alias("_size")
    )
    before = (
        Window.partitionBy("document_name").orderBy("page_no")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("_size").over(before), F.lit(0))
    parts = sizes.select(
        "document_name", "page_no", F.floor(start / F.lit(part_chars)).cast("int").alias("part")
    ).distinct()
    placed = left_lookup(
        pages, settle(parts, "page-parts"), [("document_name", "document_name"), ("page_no", "page_no")]
    )
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return placed.groupBy("document_name", "part").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text")
    )


def check_text_length(documents: DataFrame, min_chars: int = 100) -> DataFrame:
    """Add ``error``: set when the text is too short to be labelled."""
    short = F.coalesce(F.col("text_len"), F.lit(0)) < min_chars
    return documents.withColumn("error", F.when(short, F.lit("Insufficient text")))


def element_text(html: Column) -> Column:
    """Text of a fragment: each text node stripped, nothing between them."""
    bare = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    text = decode_entities(strip(F.regexp_replace(bare, r"\s*<[^>]*>\s*", "")))
    return F.btrim(text, F.lit("".join(BLANKS) + "\u00a0"))


def html_rows(
    pages: DataFrame, key: str = "page_id", table_tag: str = "table", row_tag: str = "tr",
    cell_tag: str = "td", min_cells: int = 3,
) -> DataFrame:
    """Rows of the first table: ``key, row_no, cells, link``.

    The header row and rows with fewer than ``min_cells`` cells go; ``link`` is
    the first address in the row, '' without one. Rows and cells of a table
    inside a cell count as rows of their own and as cells of the outer row.
    """
    tables = pages.select(key, first_element(F.col("html"), table_tag).alias("_table"))
    rows = tables.select(
        key, F.posexplode(element_bodies(F.col("_table"), row_tag)).alias("row_no", "_row")
    ).where("row_no > 0")
    cells = F.transform(element_bodies(F.col("_row"), cell_tag), element_text)
    # By way of `inline`: a filter would be pushed below the parsing and run it twice.
    enough = F.filter(F.array(F.struct(cells.alias("cells"))), lambda row: F.size(row["cells"]) >= min_cells)
    link = F.coalesce(F.get(link_addresses(F.col("_row")), F.lit(0)), F.lit(""))
    return rows.select(key, "row_no", link.alias("link"), F.inline(enough)).select(key, "row_no", "cells", "link")


def report_index(rows: DataFrame, folder: str) -> DataFrame:
    """Index rows from table rows: three leading cells, link, local path, document name."""
    name = base_name(drop_query(F.col("link")))
    return rows.select(
        F.get("cells", F.lit(0)).alias("stock_code"),
        F.get("cells", F.lit(1)).alias("listed_company_name"),
        F.get("cells", F.lit(2)).alias("announcement_date"),
        F.col("link").alias("hyperlink"),
        F.when(name != "", F.concat(F.lit(folder.rstrip("/") + "/"), name))
        .otherwise(F.lit("")).alias("pdf_path"),
        F.when(name != "", split_stem(name)).otherwise(F.lit("")).alias("document_name"),
    )


def resolve_link(base: Column, href: Column) -> Column:
    """A link as seen from the page at ``base``, dot segments resolved."""
    origin = F.regexp_extract(base, r"(?i)\A([a-z][a-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"(?i)\A([a-z][a-z0-9+.\-]*:)", 1)
    page = F.regexp_replace(base, r"(?s)#.*\z", "")
    bare = F.regexp_replace(page, r"(?s)\?.*\z", "")
    path = F.substring(bare, F.length(origin) + 1, F.length(bare))
    folder = F.regexp_extract(path, r"(?s)\A(.*/)", 1)
    target = F.when(F.startswith(href, F.lit("/")), href).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), href)
    )
    route = F.regexp_extract(target, r"(?s)\A([^?#]*)", 1)
    rest = F.substring(target, F.length(route) + 1, F.length(target))
    parts = F.split(route, "/")
    last = F.element_at(parts, -1)
    walked = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda seen, part: F.when(part == ".", seen)
        .when(
            part == "..",
            F.when(F.size(seen) > 1, F.slice(seen, 1, F.size(seen) - 1)).otherwise(seen),
        )
        .otherwise(F.array_append(seen, part)),
    )
    clean = F.concat(
        F.array_join(walked, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    )
    return (
        F.when(href.rlike(r"(?i)\A[a-z][a-z0-9+.\-]*:"), href)
        .when(href == "", base)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("?")), F.concat(bare, href))
        .when(F.startswith(href, F.lit("#")), F.concat(page, href))
        .otherwise(F.concat(origin, clean, rest))
    )


def harvest_links(
    pages: DataFrame, base: Column, suffix: str = ".pdf", key: str = "page_id",
    table_tag: str = "table",
) -> DataFrame:
    """Addresses in the first table that end in ``suffix``: ``key, position, url, file_name``."""
    tables = pages.select(
        key, base.alias("_base"), first_element(F.col("html"), table_tag).alias("_table")
    )
    found = tables.select(
        key, "_base", F.posexplode(link_addresses(F.col("_table"))).alias("position", "_href")
    )
    url = resolve_link(F.col("_base"), F.col("_href"))
    return (
        found.where(F.endswith(F.lower("_href"), F.lit(suffix.lower())))
        .select(key, "position", url.alias("url"))
        .withColumn("file_name", base_name(drop_query(F.col("url"))))
    )
