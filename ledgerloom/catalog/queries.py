"""Registered queries: ``name -> f(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import shapes as S
from ledgerloom.functions import cells, codes, names, text
from ledgerloom.functions.named import register_functions
from ledgerloom.operators import chunks as C
from ledgerloom.operators import grid as G
from ledgerloom.operators import joins as J
from ledgerloom.operators import latest as L
from ledgerloom.operators import pages as PG
from ledgerloom.operators import payloads as P
from ledgerloom.operators import reports as R
from ledgerloom.operators import sets
from ledgerloom.operators import silver as V
from ledgerloom.operators import worklist as W
from ledgerloom.operators.neighbours import with_neighbours
from ledgerloom.operators.positions import running_total
from ledgerloom.operators.similarity import nearest_vectors
from ledgerloom.plans import bronze, build, releases, views
from ledgerloom.session import scratch_path, settle
from ledgerloom.sinks import files as sinks
from ledgerloom.sources import files as sources
from ledgerloom.sources.records import read_records
from ledgerloom.streaming import flags as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[S.Tables], DataFrame]):
    QUERIES[function.__name__] = lambda spark, folder: function(S.Tables(spark, folder))
    return function


# Entity master, datasets, exports


def _boards(t: S.Tables) -> list[DataFrame]:
    return [S.hkex_main(t), S.hkex_gem(t), S.hkex_isin(t)]


@query
def entity_master(t):
    return sets.entity_master(_boards(t))


@query
def firm_dataset(t):
    return views.firm_dataset(S.funda_q_isin(t), entity_master(t))


@query
def document_dataset(t):
    return views.document_dataset(S.opinion_flags(t), S.report_index(t), entity_master(t))


@query
def dataset_with_documents(t):
    return views.dataset_with_documents(firm_dataset(t), document_dataset(t), first_year=1998)


@query
def dataset_with_documents_by_date(t):
    return views.dataset_with_documents(
        firm_dataset(t), document_dataset(t), first_year=1998, formats=("yyyy-MM-dd", "dd/MM/yyyy")
    )


@query
def recent_dataset(t):
    return views.recent_dataset(firm_dataset(t), 1999)


@query
def recent_documents(t):
    return views.recent_documents(document_dataset(t))


@query
def classified_firm_quarters(t):
    return views.classified_firm_quarters(
        S.funda_q_isin(t), S.classified(t), S.hkex_gem(t), S.hkex_main(t)
    )


@query
def isin_keys(t):
    return sinks.sorted_keys(views.isin_keys(_boards(t)))


@query
def stock_code_keys(t):
    return views.stock_code_keys(_boards(t))


@query
def board_codes_repeated(t):
    codes_ = [sets.ordinary_shares(b).select("stock_code") for b in (S.hkex_gem(t), S.hkex_main(t))]
    return sinks.sorted_keys(sets.union_all(codes_), distinct=False)


@query
def listing_rows(t):
    columns = ["stock_code", "isin", "company", "stock_type"]
    return sets.union_all([f.select(*columns) for f in _boards(t)])


@query
def fundamentals_annual(t):
    return sources.fundamentals(
        S.g_funda(t), views.EXCHANGE | views.INDUSTRIAL, views.ANNUAL_COLUMNS
    )


@query
def fundamentals_quarterly(t):
    return sources.fundamentals(
        S.g_fundq(t), views.EXCHANGE | views.INDUSTRIAL, views.QUARTER_COLUMNS
    )


@query
def fundamentals_by_isin(t):
    rows = sources.fundamentals(S.g_fundq(t), views.INDUSTRIAL, None)
    return sources.restrict_to_keys(rows, views.isin_keys(_boards(t)), "isin")


# Matching


@query
def unmatched_firms(t):
    return views.unmatched_firms(S.funda_q_170(t), entity_master(t))


@query
def unmatched_listings(t):
    return views.unmatched_listings(entity_master(t), S.funda_q_170(t))


@query
def matched_rows(t):
    return J.match_rows(S.funda_a(t), S.hkex_isin(t), "isin", "_hkex")


def _reconciliation(name: str) -> None:
    QUERIES[f"reconciliation_{name}"] = lambda spark, folder: views.reconciliation(
        S.funda_a(S.Tables(spark, folder)), S.hkex_isin(S.Tables(spark, folder))
    )[name]


for _name in (
    "matched_firms", "totals", "matched", "missing_left_rows", "missing_left_keys",
    "missing_left", "missing_right_rows", "missing_right_keys", "missing_right",
):
    _reconciliation(_name)


@query
def match_report(t):
    return J.match_report(
        S.funda_q_170(t), entity_master(t), "isin", ["isin", "gvkey"], ["isin", "stock_code"]
    )


@query
def yearly_panel(t):
    rows = S.funda_q_isin(t).withColumn("qrt", (F.col("fqtr") < 4).cast("int"))
    return sets.yearly_panel(rows, "fyearq", "gvkey", "qrt")


# Latest records and one row per group


def _per_board(t, function) -> DataFrame:
    """The same over each board, all of whose rows together are the listings."""
    boards = {"gem": S.hkex_gem(t), "main": S.hkex_main(t)}
    return sets.union_all(
        [function(df).withColumn("board", F.lit(name)) for name, df in boards.items()]
    )


@query
def last_listing_dates(t):
    return _per_board(
        t, lambda b: L.max_per_key(b, "stock_code", "listing_date", "max_listing_date")
    )


@query
def latest_listings(t):
    columns = list(views.SHARED_LISTING_COLUMNS)
    return _per_board(t, lambda b: L.latest_per_key(b.select(*columns), "stock_code", "listing_date"))


@query
def latest_listing_join(t):
    def joined(board):
        side = board.select(
            "stock_code", "listing_date", F.col("company").alias("listed_company"), "sponsors"
        )
        return L.latest_join(S.hkex_isin(t), side, ("stock_code", "stock_code"), "listing_date")

    return _per_board(t, joined)


@query
def first_row_per_quarter(t):
    return L.one_per_group(
        S.funda_q_isin(t), ["gvkey", "datacqtr"], [F.desc("datadate"), "isin", "conm"]
    )


@query
def year_end_opinions(t):
    opinions = S.classified(t).where("cs_fqtr = 4").groupBy("cs_gvkey", "cs_datacqtr").agg(
        F.max("aof_qualified_op").alias("aof_qualified_op")
    )
    quarters = S.funda_q_170(t).select("gvkey", "datacqtr", "datadate")
    return J.left_lookup(
        quarters, opinions, [(cells.to_key(F.col("gvkey")), "cs_gvkey"), ("datacqtr", "cs_datacqtr")]
    )


# Offers and boards


@query
def merged_offers(t):
    return V.merge_offer_rows(S.offers(t), S.OFFER_ORDER)


@query
def merged_offers_onto_parents(t):
    return V.merge_offer_rows(S.offers(t), S.OFFER_ORDER, mode="parent")


@query
def main_board_silver(t):
    return V.merge_offer_rows(S.offers(t), S.OFFER_ORDER).transform(
        J.join_master, S.hkex_isin(t), "stock_code"
    )


@query
def growth_board_silver(t):
    columns = ["source_file", "stock_code", "company", "place_of_incorporation", "listing_date", "sponsors"]
    return _per_board(t, lambda b: J.join_master(b.select(*columns), S.hkex_isin(t), "stock_code"))


@query
def isin_master(t):
    agency = S.hkex_isin(t).drop("hkex_co_name")
    exchange = t.supplier.select(
        F.upper("s_name").alias("company"), S.isin("s_suppkey").alias("isin"),
        F.col("s_suppkey").alias("stock_code"), F.lit("WARRANT").alias("stock_type"),
    )
    short = t.customer.select(
        F.col("c_custkey").alias("stock_code"), F.col("c_name").alias("hkex_co_name")
    )
    return V.build_isin_master(agency, exchange, short)


# Sheets


@query
def main_board_bronze(t):
    return bronze.main_board(S.main_grid(t))


@query
def growth_board_bronze(t):
    return bronze.growth_board(S.gem_grid(t))[0]


@query
def growth_board_rejects(t):
    return bronze.growth_board(S.gem_grid(t))[1]


@query
def sheet_rejects(t):
    main = S.main_grid_without_keys(t, 1995)
    return bronze.sheet_rejects(main, S.gem_grid(t), *S.broken_isin_grids(t))


@query
def isin_list_first_table(t):
    return bronze.isin_list(S.isin_grid(t))


@query
def isin_list_second_table(t):
    return bronze.isin_list(S.isin_grid(t), nth=2)


@query
def national_agencies(t):
    return bronze.national_agencies(S.isin_grid(t))


@query
def short_names(t):
    grid = S.isin_grid(t).withColumn("cells", F.slice("cells", 3, 2))
    return bronze.short_names(grid)


@query
def table_bounds(t):
    return G.table_bounds(S.isin_grid(t), nth=2)


@query
def stock_type_legends(t):
    return G.parse_legend(S.legends(t), "legend")


@query
def combined_boards(t):
    main = bronze.main_board(S.main_grid(t)).drop("row_idx")
    growth = bronze.growth_board(S.gem_grid(t))[0].drop("row_idx")
    return G.union_files([main, growth])


def _built_isin(t):
    landed = settle(S.isin_grid(t), "landed")
    names_ = landed.withColumn("cells", F.slice("cells", 3, 2))
    return build.isin_table(landed, landed, names_)


@query
def built_main_board(t):
    return build.main_table(S.main_grid(t), _built_isin(t))


@query
def built_growth_board(t):
    return build.gem_table(S.gem_grid(t), _built_isin(t))[0]


@query
def built_entity_master(t):
    master = _built_isin(t)
    growth, _ = build.gem_table(S.gem_grid(t), master)
    return sets.entity_master([build.main_table(S.main_grid(t), master), growth, master])


# Report texts


def _with_text(t, column):
    return S.reports(t).select("document_name", column(F.col("text")).alias("text"))


@query
def ascii_texts(t):
    return t.documents.select("doc_id", text.remove_non_ascii(F.col("text")).alias("text"))


@query
def texts_without_table_lines(t):
    return t.documents.select(
        "doc_id", text.remove_table_lines(F.col("text"), share=0.02).alias("text")
    )


@query
def keyword_lines(t):
    lines = _with_text(t, text.remove_non_ascii).select(
        "document_name", F.posexplode(text.text_lines(F.col("text"))).alias("line_no", "line")
    )
    return lines.select(
        "document_name", "line_no",
        text.has_keyword(F.col("line"), text.START_KEYWORDS).cast("int").alias("starts"),
        text.has_keyword(F.col("line"), text.STOP_KEYWORDS).cast("int").alias("stops"),
        F.round(text.digit_share(F.col("line")), 6).alias("digit_share"),
    )


@query
def texts_without_stop_blocks(t):
    ascii_texts_ = _with_text(t, text.remove_non_ascii)
    return ascii_texts_.withColumn("text", text.remove_stop_blocks(F.col("text")))


@query
def heading_sections(t):
    return R.section_documents(_with_text(t, text.remove_non_ascii))


@query
def sliced_reports(t):
    return R.slice_documents(S.reports(t))


@query
def opinion_phrase_flags(t):
    return R.phrase_flags(R.slice_documents(S.reports(t)))


@query
def opinion_flags_in_sql(t):
    """The same flags by the functions that SQL users have."""
    register_functions(t.spark)
    R.slice_documents(S.reports(t)).createOrReplaceTempView("sliced_reports_to_flag")
    return t.spark.sql("""
        SELECT document_name, report_date(document_name) AS report_date, flags.*
        FROM (SELECT document_name, flag_opinion(text) AS flags FROM sliced_reports_to_flag WHERE text <> '')""")


@query
def unclear_opinions(t):
    flags = R.phrase_flags(S.reports(t))
    unclear = codes.is_unclear(
        F.col("qualified_opinion"), F.col("adverse_opinion"), F.col("disclaimer_of_opinion")
    )
    return flags.withColumn("unclear", unclear)


@query
def folded_texts(t):
    return t.documents.select(
        "doc_id", text.fold_text(text.remove_non_ascii(F.col("text"))).alias("text")
    )


@query
def decoded_texts(t):
    latin = ~F.col("text").rlike(r"[^\x00-\xFF]") & (F.col("lang") != "en")
    content = F.when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return t.documents.select("doc_id", text.decode_text(content).alias("text"))


@query
def texts_for_paths(t):
    paths = W.document_worklist(S.report_index(t))
    return R.texts_for_paths(paths, S.reports(t))


@query
def document_branch(t):
    flags = R.flag_paths(W.document_worklist(S.report_index(t)), S.reports(t))
    return views.document_dataset(flags, S.report_index(t), entity_master(t))


@query
def incremental_flags(t):
    """Flags of an earlier run, and of the documents that came since."""
    tables = build.document_tables(S.report_index(t), S.reports(t), S.opinion_flags(t))
    return tables["auditor_opinion_flags"]


@query
def flags_for_codes(t):
    """The document branch for a list of codes: texts of other codes are not touched."""
    codes_ = t.labels.where("quality = 1").select(F.col("doc_id").alias("stock_code"))
    return R.flag_paths(W.document_worklist(S.report_index(t), codes_), S.reports(t))


@query
def double_keys_joined(t):
    """Whole and broken numbers as keys against whole ones; only equal numbers meet."""
    prices = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).alias("half"))
    names_ = t.nation.select(F.col("n_nationkey").alias("key"), "n_name")
    return J.left_lookup(prices, names_, [("half", "key")])


@query
def new_document_flags(t):
    done = S.opinion_flags(t).select(F.concat("document_name", F.lit(".pdf")).alias("document_name"))
    return R.flag_new_documents(S.reports(t), done)


# Names and codes


@query
def report_dates(t):
    return t.documents.select("doc_id", names.name_date(F.col("text")).alias("report_date"))


@query
def file_name_parts(t):
    link = names.drop_query(F.col("hyperlink"))
    return S.report_index(t).select(
        "stock_code",
        names.base_name(link).alias("file_name"),
        names.stem(link).alias("stem"),
        names.extension(names.base_name(link)).alias("extension"),
    )


@query
def archive_names(t):
    return S.report_index(t).select(
        "stock_code", names.archive_name(F.col("stock_code"), F.col("pdf_path")).alias("name")
    )


@query
def original_names(t):
    name = names.archive_name(F.col("stock_code"), F.col("pdf_path"))
    return S.report_index(t).select(
        "stock_code", names.original_name(name).alias("name"),
        names.archive_name(F.col("stock_code"), name).alias("name_twice"),
    )


@query
def archived_index(t):
    index = S.report_index(t).withColumn(
        "pdf_path", F.concat(F.lit("data/raw/auditor_pdfs/"), F.col("announcement_date"), F.lit(".pdf"))
    )
    return W.archive_paths(index, ["stock_code"])


@query
def restored_index(t):
    return W.restore_paths(W.archive_paths(S.report_index(t), ["stock_code"]), ["stock_code"])


@query
def ids_from_names(t):
    path = F.concat(
        F.lit("data/press/press_releases_"), F.col("event_id").cast("string"),
        F.when(F.col("event_type") == "error", F.lit(".tmp")).otherwise(F.lit(".csv")),
    )
    return t.events.select("event_id", names.id_from_name(path).alias("id"))


@query
def market_classes(t):
    return t.orders.select(
        "o_orderkey", codes.market_class(F.col("o_orderkey")).alias("market")
    )


# Payloads and work lists


@query
def envelope_records(t):
    return P.parse_envelopes(S.envelopes(t), S.RELEASE_SCHEMA)[0]


@query
def run_summary(t):
    return P.parse_envelopes(S.envelopes(t), S.RELEASE_SCHEMA)[1]


@query
def summary_counts(t):
    return P.summary_counts(run_summary(t))


@query
def lookup_rows(t):
    return P.parse_jsonp_lookup(S.lookups(t))


@query
def stock_id_mapping(t):
    return releases.stock_id_mapping(S.lookups(t))


def _release_round(t):
    ignore = S.id_list(t.supplier, "s_suppkey")
    existing = S.id_list(t.embeddings, "vec_id").select("id")
    return releases.ingest_releases(
        S.lookups(t), S.envelopes(t), ignore, existing, S.RELEASE_SCHEMA
    )


@query
def release_round_records(t):
    return _release_round(t)["records"]


@query
def release_round_ignore(t):
    return _release_round(t)["ignore"]


def _pending(t):
    return W.pending_list(
        S.id_list(t.documents, "doc_id"),
        S.id_list(t.labels, "doc_id").select("id"),
        S.id_list(t.embeddings, "vec_id").select("id"),
    )


@query
def pending_ids(t):
    return _pending(t)[0]


@query
def pending_counts(t):
    return _pending(t)[1]


@query
def ignore_update(t):
    return W.update_ignore(S.id_list(t.supplier, "s_suppkey"), S.release_summary(t))[0]


@query
def ignore_update_count(t):
    return W.update_ignore(S.id_list(t.supplier, "s_suppkey"), S.release_summary(t))[1]


@query
def document_worklist(t):
    return W.document_worklist(S.report_index(t))


@query
def document_worklist_for_codes(t):
    return W.document_worklist(
        S.report_index(t), t.labels.select(F.col("doc_id").alias("stock_code"))
    )


@query
def normalized_labels(t):
    return P.normalize_labels(S.label_responses(t), min_chars=300)


@query
def label_summary(t):
    return P.label_summary(P.normalize_labels(S.label_responses(t)))


# Pages

SKIP = ("ation", "que")
KEEP = ("the ", "les ")


@query
def kept_pages(t):
    return PG.filter_pages(S.report_pages(t), SKIP, KEEP)


@query
def joined_pages(t):
    return PG.join_pages(PG.filter_pages(S.report_pages(t), SKIP, KEEP), part_chars=200)


@query
def checked_pages(t):
    totals = PG.page_totals(PG.filter_pages(S.report_pages(t), SKIP, KEEP))
    return PG.check_text_length(totals, 400)


@query
def html_list_rows(t):
    rows = PG.html_rows(t.pages, table_tag="ul", row_tag="li", cell_tag="a", min_cells=1)
    return rows.withColumn("cells", F.array_join("cells", "|"))


@query
def html_report_index(t):
    rows = PG.html_rows(t.pages, table_tag="ul", row_tag="li", cell_tag="a", min_cells=1)
    return PG.report_index(rows, "data/raw/auditor_pdfs")


@query
def harvested_links(t):
    return PG.harvest_links(t.pages, F.col("url"), suffix="N", table_tag="ul")


# Chunks

CATEGORIES = {
    "first": [1.0] + [0.0] * 63, "halves": [1.0] * 32 + [-1.0] * 32, "all": [1.0] * 64,
}


@query
def document_chunks(t):
    return C.chunk_texts(t.documents, "doc_id", size=1000, overlap=200)


def _chunk_vectors(t) -> DataFrame:
    """Embeddings as the chunks of documents of seven chunks each."""
    return t.embeddings.withColumn("document", F.floor(F.col("vec_id") / 7))


@query
def top_chunks(t):
    return C.top_chunks(_chunk_vectors(t), "document", "vec_id", "embedding", CATEGORIES, k=2)


@query
def nearest_chunks(t):
    """Every fiftieth vector as a query against all of them."""
    vectors = t.embeddings.select("vec_id", "embedding")
    asked = vectors.where(F.col("vec_id") % 50 == 0).withColumnRenamed("vec_id", "query_id")
    return nearest_vectors(vectors, asked, 5)[0]


@query
def voted_labels(t):
    weighted = _chunk_vectors(t).withColumn("weight", (F.col("vec_id") % 3 + 1).cast("bigint"))
    return C.vote(weighted, "document", "label", "weight")


# Samples and previews


@query
def document_sample(t):
    return sets.random_sample(t.documents, "doc_id", 100, seed=7).select("doc_id", "lang", "n_chars")


@query
def document_preview(t):
    return sets.preview(t.documents.select("doc_id", "lang", "n_chars"), ["doc_id"], 10)


# Files: written to the scratch folder and read back


@query
def csv_table_round_trip(t):
    target = scratch_path(t.spark, "csv")
    documents = t.documents.select("doc_id", "text", "lang")
    sinks.export_queries({"select_documents": documents}, target)
    return sources.read_csv_table(
        t.spark, f"{target}/documents", "doc_id bigint, text string, lang string"
    )


@query
def quoted_records(t):
    """Documents as CSV with line ends in cells; the lines of each record as it stands in the files."""
    target = scratch_path(t.spark, "records")
    documents = t.documents.select("doc_id", "lang", F.col("text"))
    sinks.export_queries({"select_documents": documents}, target)
    records = read_records(t.spark, f"{target}/documents").where(F.col("record_no") > 0)
    lines = F.size(F.split("record", "\n", -1))
    return records.select(
        F.split("record", ",", 2)[0].cast("bigint").alias("doc_id"),
        lines.cast("bigint").alias("n_lines"),
    )


@query
def table_replaced_from_itself(t):
    target = scratch_path(t.spark, "table")
    sinks.replace_table(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), target)
    stored = t.spark.read.parquet(target)
    rows = sinks.replace_table(stored.where("o_orderkey % 3 <> 0"), target)
    return t.spark.read.parquet(target).withColumn("reported", F.lit(rows).cast("bigint"))


@query
def replaced_table(t):
    target = scratch_path(t.spark, "table")
    rows = sinks.replace_table(t.orders.select("o_orderkey", "o_custkey"), target)
    return t.spark.read.parquet(target).agg(
        F.count("*").alias("stored"), F.sum("o_custkey").alias("key_sum")
    ).withColumn("reported", F.lit(rows).cast("bigint"))


@query
def key_list_round_trip(t):
    target = scratch_path(t.spark, "keys")
    sinks.export_keys(t.lineitem.select("l_suppkey"), target)
    return sources.read_id_list(t.spark, target)


@query
def order_positions(t):
    """Line numbers over all orders, each order as many lines as it has items."""
    sizes = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("items"))
    return running_total(sizes, "l_orderkey", "items", "items_before")


@query
def release_files_round_trip(t):
    target = scratch_path(t.spark, "releases")
    sinks.write_per_key(S.release_summary(t), target, "stock_id")
    return sources.read_per_key(t.spark, target, "seq bigint, status string, stock_id string")


@query
def document_files_round_trip(t):
    """A file per document, those in Latin-1 that cannot be taken for UTF-8, and back."""
    target = scratch_path(t.spark, "documents")
    documents = t.documents.select(F.col("doc_id").cast("string").alias("document_name"), "text")
    fits = F.col("text").rlike(r"\A[\x00-\xFF]*\z")
    latin = F.encode(F.when(fits, F.col("text")).otherwise(F.lit("")), "ISO-8859-1").cast("string")
    marked = documents.withColumn("_latin", F.coalesce(fits & ~F.is_valid_utf8(latin), F.lit(False)))
    back = []
    for encoding, rows in (("UTF-8", marked.where("NOT _latin")), ("ISO-8859-1", marked.where("_latin"))):
        sinks.write_documents(rows.drop("_latin"), f"{target}/{encoding}", encoding=encoding)
        back.append(sources.read_written_documents(t.spark, f"{target}/{encoding}"))
    return sets.union_all(back)


@query
def landed_sheets(t):
    target = scratch_path(t.spark, "sheets")
    key = F.col("c_custkey").cast("string").alias("key")
    wide = [F.lit(i).cast("string").alias(f"more_{i}") for i in range(40)]
    rows = t.customer.select(
        key, "c_name", F.lit(None).cast("string").alias("none"),
        F.concat("c_mktsegment", F.lit(",")).alias("segment"), *wide,
    )
    rows.orderBy(F.col("key").cast("bigint")).write.options(quote='"', escape='"').csv(target)
    grid = sources.read_sheets(t.spark, f"{target}/*.csv")
    keyed = grid.withColumn("key", F.get("cells", F.lit(0)).cast("bigint"))
    near = with_neighbours(keyed, ["source_file"], ["row_idx"], ["key", "row_idx"], back=1)
    follows = (F.col("prev_1.key") < F.col("key")) & (F.col("prev_1.row_idx") + 1 == F.col("row_idx"))
    first = F.col("prev_1").isNull() & (F.col("row_idx") == 0)
    return near.select(
        F.array_join("cells", "|", "-").alias("cells"),
        F.coalesce(follows, first).cast("int").alias("in_order"),
    )


def _written_exports(t) -> list[str]:
    target = scratch_path(t.spark, "exports")
    tables = {
        "hkex_main": S.hkex_main(t), "hkex_gem": S.hkex_gem(t), "hkex_isin": S.hkex_isin(t),
        "funda_q_isin": S.funda_q_isin(t), "funda_q_170": S.funda_q_170(t),
        "auditor_opinion_flags": S.opinion_flags(t), "hkex_auditor_reports": S.report_index(t),
    }
    made = views.views(tables)
    sinks.register_views(made)
    read = t.spark.table
    exports = views.export_set(
        read("hkex_dataset"), read("hkex_document_dataset"), tables["hkex_isin"],
        read("non_match_funda_q_170"), read("non_match_hkex_isin"), first_year=1998,
    )
    return sinks.export_queries(exports, target)


def _export(t, path: str) -> DataFrame:
    return t.spark.read.options(header="true", multiLine="true", quote='"', escape='"').csv(path)


@query
def export_set_rows(t):
    counts = [
        _export(t, path).agg(F.count("*").alias("rows"))
        .select(F.lit(path.rsplit("/", 1)[1]).alias("export"), "rows")
        for path in _written_exports(t)
    ]
    return sets.union_all(counts)


@query
def export_set_contents(t):
    """Every cell of the six exports as it stands in the files."""
    lines = []
    for path in _written_exports(t):
        export = _export(t, path)
        cells = [F.concat(F.lit(f"{c}="), F.coalesce(c, F.lit("-"))) for c in sorted(export.columns)]
        lines.append(export.select(F.lit(path.rsplit("/", 1)[1]).alias("export"), F.concat_ws("|", *cells).alias("line")))
    return sets.union_all(lines)


@query
def streamed_flags(t):
    base = scratch_path(t.spark, "stream")
    # The table may be a file or a folder of files. A stream takes a plain path for a folder; a
    # pattern, here of one name, stands for either.
    source = t.spark.readStream.schema(t.documents.schema).parquet(f"{t.folder}/documents[.]parquet")
    arriving = S.reports(_Stream(source))
    stream.flag_stream(arriving, f"{base}/flags", f"{base}/checkpoint").awaitTermination()
    return stream.read_flags(t.spark, f"{base}/flags")


class _Stream:
    """Stands in for the tables where only ``documents``, as a stream, is read."""

    def __init__(self, documents: DataFrame):
        self.documents = documents
