"""A whole run from sheets, fundamentals, a report page and texts."""

from ledgerloom.operators import pages as PG
from ledgerloom.plans import build, views
from ledgerloom.sinks import files as sinks

GRID = "source_file string, row_idx long, cells array<string>"


def sheet(name, *lines):
    return [(name, i, list(line)) for i, line in enumerate(lines)]


def grids(spark):
    def offer(code, mark, funds):
        return ["1", code, "Firm", "p", "2014-01-01", "s", "r", "v", funds, "1.0", mark]

    main = sheet("Main_2", ["t"], ["h"], offer('"', "(b)", "9"), offer("5", "(a)", "3"))
    main += sheet("Main_1", ["t"], ["h"], offer("5", "(a)", "1"), offer('"', "(b)", "2"), offer("6", "(a)", "4"))
    names = [f"c{i}" for i in range(13)]
    gem = sheet("GEM_1", *[[None]] * 9, names, [None], ["2015-01-01", "8001", "Gem", *names[3:]], ["Total"])
    gem += sheet("GEM_2", ["broken"])
    head = ["Name", "ISIN", "Code", "Type", "Place", "Agency"]
    agency = sheet(
        "isino", head, ["One", "I5", "5", "ORD SH", "HK", "AG"], ["Gem", "I8", "8001", "ORD SH", "HK", "AG"],
        [None] * 6, ["Agencies"], ["Code", "Description"], ["AG", "An agency"], [None, None],
    )
    agency += [("isino", 16, ["Types (ORD SH – Ordinary shares; W – Warrants)"])]
    exchange = sheet("sehk", head, ["No", "I0", "1", "W", "HK", "AG"], [None] * 6, head, ["Six", "I6", "6", "ORD SH", "KY", "AG"])
    short = sheet("names", ["Code", "Name"], ["5", "ONE"])
    return [spark.createDataFrame(g, GRID) for g in (main, gem, agency, exchange, short)]


def test_a_whole_run(spark, rows, tmp_path):
    listings = build.listing_tables(*grids(spark))
    assert rows(
        listings["hkex_main"], "source_file", "stock_code", "funds_raised_hk", "funds_raised_intl", "isin", "hkex_co_name"
    ) == [("Main_1", 5, "1", "2", "I5", "ONE"), ("Main_1", 6, "4", None, "I6", None), ("Main_2", 5, "3", None, "I5", "ONE")]
    assert rows(listings["hkex_gem"], "stock_code", "company", "company_isino", "place_of_incorporation_isino") == [
        (8001, "Gem", "Gem", "HK")
    ]
    assert rows(listings["desc_hkex_national_agencies"]) == [("AG", "An agency")]
    assert rows(listings["desc_hkex_stock_types"]) == [("ORD SH", "Ordinary shares"), ("W", "Warrants")]
    assert rows(listings["rejected_files"], "source_file") == [("GEM_2",)]

    source = "exchg int, indfmt string, popsrc string, consol string, datafmt string"
    tail = ("INDL", "I", "C", "HIST_STD")
    annual = spark.createDataFrame([("1", "I5", "F", "2014-12-31", 2014, 170, *tail)],
                                   f"gvkey string, isin string, conm string, datadate string, fyear int, {source}")
    quarterly = spark.createDataFrame(
        [("1", "I5", "F", "2014-12-31", "2014Q4", "2014Q4", 2014, 4, 170, *tail),
         ("2", "I9", "G", "2014-12-31", "2014Q4", "2014Q4", 2014, 4, 170, *tail),
         ("3", "I6", "H", "2014-12-31", "2014Q4", "2014Q4", 2014, 4, 999, *tail),
         ("4", "I5", "F", "2014-12-31", "2014Q4", "2014Q4", 2014, 4, 170, "FS", *tail[1:])],
        "gvkey string, isin string, conm string, datadate string, datacqtr string, datafqtr string, fyearq int, fqtr int, " + source,
    )
    page = "<table><tr><th>x</th></tr><tr><td>5</td><td>One</td><td>2015-03-31</td><td><a href='d/r_20150331.pdf'>f</a></td></tr></table>"
    index = PG.report_index(PG.html_rows(spark.createDataFrame([(1, page)], "page_id int, html string")), "data/raw")
    index = index.withColumn("stock_code", index.stock_code.cast("bigint"))
    texts = spark.createDataFrame([("r_20150331", "Basis for qualified\nopinion")], "document_name string, text string")
    made = build.build(listings, annual, quarterly, index, texts)

    assert rows(made["funda_q_isin"], "gvkey") == [("1",), ("3",)]
    assert rows(made["funda_q_170"], "gvkey") == [("1",), ("2",)]
    assert rows(made["hkex_dataset"], "cs_gvkey", "hkex_stock_code") == [("1", 5), ("3", 6)]
    assert rows(made["hkex_document_dataset"], "har_stock_code", "aof_report_date", "aof_qualified_op", "hkex_full_name") == [
        (5, "2015-03-31", 1, "One")
    ]
    assert rows(made["non_match_funda_q_170"]) == [("2", "I9", "G")]
    assert rows(made["non_match_hkex_isin"], "stock_code") == [(6,), (8001,)]

    exports = views.export_set(made["hkex_dataset"], made["hkex_document_dataset"], made["hkex_isin"],
                               made["non_match_funda_q_170"], made["non_match_hkex_isin"])
    written = sinks.export_queries(exports, str(tmp_path))
    exists = [p for p in written if p.endswith("document_exists")][0]
    assert rows(spark.read.csv(exists, header=True), "cs_gvkey") == [("1",)]

    again = build.document_tables(index, texts, made["auditor_opinion_flags"])
    assert rows(again["auditor_opinion_flags"]) == rows(made["auditor_opinion_flags"])
