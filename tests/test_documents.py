"""Payloads, pages, names and work lists."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import names
from ledgerloom.operators import pages as PG
from ledgerloom.operators import payloads as P
from ledgerloom.operators import reports as R
from ledgerloom.operators import worklist as W
from ledgerloom.plans import releases


def column(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_envelopes(spark, rows):
    bodies = [
        json.dumps({"result": json.dumps([{"T": "a", "N": 1, "extra": 0}, {"T": 'b "q"\nz'}])}),
        '{"result":"[]"}', '{"result":" [ ] "}', '{"other":1}', '{"result":"[{"}', "no json", None,
        '{"result":"null"}', '{"result":null}', '{"result":"{\\"T\\":\\"x\\"}"}',
    ]
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "stock_id string, body string")
    records, summary = P.parse_envelopes(df, "struct<T:string,N:string>")
    assert rows(records) == [("0", 0, "a", "1"), ("0", 1, 'b "q"\nz', None)]
    assert rows(summary) == [
        ("0", "saved", 2), ("1", "skipped", 0), ("2", "skipped", 0), ("3", "failed", 0), ("4", "failed", 0),
        ("5", "failed", 0), ("6", "failed", 0), ("7", "skipped", 0), ("8", "failed", 0), ("9", "failed", 0),
    ]
    assert rows(P.summary_counts(summary)) == [("failed", 6, 0), ("saved", 1, 2), ("skipped", 3, 0)]


def test_lookups(spark, rows):
    item = lambda i, c, n="N": {"stockId": i, "code": c, "name": n}
    wrap = lambda items, tail=");": f" callback({json.dumps({'stockInfo': items})}{tail}\n"
    bodies = [
        wrap([item(5, "00001"), item(6, "8001")]),
        wrap([item(6, "8002"), item(7, "9000", "a)b;")], ")"),
        wrap([item(8, "1"), item(9, "bad")]),
        json.dumps({"stockInfo": [item(10, "1")]}),
        "callback({broken);", "callback({});", wrap(None), None,
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "seq long, body string")
    got = releases.stock_id_mapping(df)
    assert rows(got, "stock_id", "stock_code", "name", "market", "seq") == [
        ("5", 1, "N", "SEHK", 0), ("6", 8001, "N", "GEM", 0), ("7", 9000, "a)b;", "SEHK", 1)
    ]


def test_labels(spark, rows):
    good = '{"opinion_type": 2, "is_uncertain": 0, "going_concern": 1, "emphasis_of_matter": 1}'
    data = [("ok", 100, good), ("short", 99, good), ("none", 500, None), ("bad", 500, "```json"), ("cut", 500, good[:-1]),
            ("list", 500, "[1]"), ("null", None, good), ("part", 500, '{"opinion_type": 3}')]
    df = spark.createDataFrame(data, "filename string, text_len int, body string")
    got = {r[0]: tuple(r)[1:] for r in P.normalize_labels(df).collect()}
    assert got == {
        "ok": (None, 2, 0, 1, 1),
        "short": ("Insufficient text", None, 1, 0, 0),
        "none": ("No response after retries", None, 1, 0, 0),
        "bad": ("JSON parse failed", None, 1, 0, 0),
        "cut": ("JSON parse failed", None, 1, 0, 0),
        "list": ("JSON parse failed", None, 1, 0, 0),
        "null": ("Insufficient text", None, 1, 0, 0),
        "part": (None, 3, None, None, None),
    }
    assert rows(P.label_summary(P.normalize_labels(df))) == [(0, 1, 1, 0, 1, 1)]


def test_pages(spark, rows):
    data = [("d", 2, "Balance Sheet"), ("d", 10, "balance sheet of the Auditor"), ("d", 1, "Plain"), ("e", 1, "long " * 9),
            ("f", 1, "Notes to the financial statements")]
    pages = spark.createDataFrame(data, "document_name string, page_no int, text string")
    kept = PG.filter_pages(pages)
    assert rows(kept, "document_name", "page_no") == [("d", 1), ("d", 10), ("e", 1)]
    assert rows(PG.join_pages(kept)) == [("d", 0, "Plain\nbalance sheet of the Auditor"), ("e", 0, "long " * 9)]
    # A part begins with the first page that begins behind the limit; none is left out.
    assert rows(PG.join_pages(kept, part_chars=5)) == [
        ("d", 0, "Plain"), ("d", 1, "balance sheet of the Auditor"), ("e", 0, "long " * 9)
    ]
    assert rows(PG.check_text_length(PG.page_totals(kept), 35), "document_name", "text_len", "error") == [
        ("d", 34, "Insufficient text"), ("e", 45, None)
    ]


HTML = """<p><a href="/outside.pdf">no</a></p><TABLE class="x">
<tr><th>Code</th><th>Name</th><th>Date</th></tr>
<tr><td> 7 </td><td><b>A &amp; B</b> <!-- x --><i> Ltd</i></td><td>31/12/2013</td><td><a class='l' href='/d/r_20131231.PDF?x=1.2'>pdf</a></td></tr>
<tr><td>short</td><td>row</td></tr>
<tr><td>8</td><td>C</td><td>01/01/2014</td><td><a name="n">x</a><a href="../up/second.pdf">y</a><a href="third.pdf">z</a></td></tr>
</TABLE><table><tr><td>9</td><td>9</td><td>9</td></tr></table>"""


def test_html_tables(spark, rows):
    df = spark.createDataFrame([(1, HTML), (2, "<p>no table</p>")], "page_id int, html string")
    found = PG.html_rows(df)
    assert rows(found.select("page_id", "row_no", F.array_join("cells", "|"), "link")) == [
        (1, 1, "7|A & BLtd|31/12/2013|pdf", "/d/r_20131231.PDF?x=1.2"),
        (1, 3, "8|C|01/01/2014|xyz", "../up/second.pdf"),
    ]
    assert rows(PG.report_index(found, "data/raw")) == [
        ("7", "A & BLtd", "31/12/2013", "/d/r_20131231.PDF?x=1.2", "data/raw/r_20131231.PDF", "r_20131231"),
        ("8", "C", "01/01/2014", "../up/second.pdf", "data/raw/second.pdf", "second"),
    ]
    base = F.lit("https://host.example/a/b/page.htm?q=1")
    assert rows(PG.harvest_links(df, base)) == [
        (1, 1, "https://host.example/a/up/second.pdf", "second.pdf"),
        (1, 2, "https://host.example/a/b/third.pdf", "third.pdf"),
    ]


NESTED = """<table><tr><td>head</td></tr>
<tr><td>1</td><td>caf&eacute; &#233;&#xE9;&nbsp;</td><td>in <table><tr><td>2</td><td>3</td><td>4<a href='n.pdf'>n</a></td></tr></table></td>
<td><a data-href="no.pdf" href=b.pdf>b</a></td></tr>
<tr><td>5</td><td>a "q" &amp;lt; &unknown; &#x110000;</td><td>6</td><td><a HREF="a.pdf?x=1&amp;y='2'">c</a></td></tr></table>"""


def test_nested_tables_references_and_addresses(spark, rows):
    df = spark.createDataFrame([(1, NESTED), (2, None), (3, "<table><tr><td>x"), (4, "</table>")], "page_id int, html string")
    found = PG.html_rows(df)
    assert rows(found.select("page_id", "row_no", F.array_join("cells", "|"), "link")) == [
        (1, 1, "1|café éé|in234n|2|3|4n|b", "n.pdf"),
        (1, 2, "2|3|4n", "n.pdf"),
        (1, 3, '5|a "q" &lt; &unknown; \ufffd|6|c', "a.pdf?x=1&y='2'"),
    ]
    links = PG.harvest_links(df, F.lit("http://h/"), suffix=".pdf")
    assert rows(links, "page_id", "url") == [(1, "http://h/b.pdf"), (1, "http://h/n.pdf")]


@pytest.mark.parametrize("href, url", [
    ("x.pdf", "http://h/a/b/x.pdf"), ("/x.pdf", "http://h/x.pdf"), ("//g/x.pdf", "http://g/x.pdf"),
    ("https://g/x.pdf", "https://g/x.pdf"), ("./x.pdf", "http://h/a/b/x.pdf"), ("../../../x.pdf", "http://h/x.pdf"),
    ("x/./y/../z.pdf?q=../k", "http://h/a/b/x/z.pdf?q=../k"), ("..", "http://h/a/"), ("?p=1", "http://h/a/b/c?p=1"),
    ("#top", "http://h/a/b/c?q=2#top"), ("", "http://h/a/b/c?q=2"),
])
def test_links(spark, href, url):
    from urllib.parse import urljoin

    assert urljoin("http://h/a/b/c?q=2", href) == url
    assert column(spark, lambda c: PG.resolve_link(F.lit("http://h/a/b/c?q=2"), c), [href]) == [url]


def test_file_names(spark):
    assert column(spark, names.stem, ["a/b.tar.gz", "x", "d.e/f", ".pdf", "n.", "q.PDF"]) == ["b.tar", "x", "f", ".pdf", "n.", "q"]
    assert column(spark, names.extension, ["b.tar.gz", "x", ".pdf", "..pdf", ".a.pdf", "n."]) == [".gz", "", "", "", ".pdf", "."]
    assert column(spark, names.name_date, ["r_20140630_20150101", "1234567", "x99999999", ""]) == ["2014-06-30", "", "9999-99-99", ""]
    assert column(spark, names.id_from_name, ["d/press_releases_00007.csv", "press_releases_.csv", "x.csv"]) == ["00007", None, None]


def test_archive_names_turn_back(spark):
    paths = ["p/r_20140630_x.pdf", "p/no date.PDF", "p/20140630", "p/a.b.20111111.22222222.pdf", "p/[c8]-[odd.pdf"]
    build = lambda c: names.archive_name(F.lit(7), c)
    assert column(spark, build, paths)[:3] == [
        "[c7]-[20140630]-[_x]-[r_20140630_x].pdf", "[c7]-[00000000]-[no date]-[no date].PDF", "[c7]-[20140630]-[]-[20140630]"
    ]
    assert column(spark, lambda c: build(build(c)), paths) == column(spark, build, paths)
    back = column(spark, lambda c: names.original_path(names.archive_path(F.lit(7), c), "p"), paths)
    assert back == paths
    assert column(spark, names.original_name, ["r.pdf", "[c7]-[x].pdf"]) == ["", ""]


def test_path_map(spark, rows):
    index = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "k int, pdf_path string")
    mapping = spark.createDataFrame([(2, "a", "second"), (1, "a", "first"), (9, "z", "zz")], "k int, old_path string, new_path string")
    assert rows(W.apply_path_map(index, mapping, ["k"])) == [(1, "first"), (2, "first"), (3, "b"), (4, None)]


def test_archiving_and_restoring_an_index(spark, rows):
    data = [(1, "data/raw/auditor_pdfs/r_20140630.pdf"), (2, "data/raw/auditor_pdfs/r_20140630.pdf"), (3, " "), (4, None),
            (5, "data/processed/auditor_pdfs/[c5]-[20150101]-[]-[20150101].pdf"), (6, "data/processed/auditor_pdfs/[c9]-[x].pdf")]
    index = spark.createDataFrame(data, "stock_code int, pdf_path string")
    archived = W.archive_paths(index, ["stock_code"])
    first = "data/processed/auditor_pdfs/[c1]-[20140630]-[]-[r_20140630].pdf"
    other = "data/processed/auditor_pdfs/[c6]-[00000000]-[[c9]-[x]]-[[c9]-[x]].pdf"
    assert rows(archived) == [(1, first), (2, first), (3, " "), (4, None), data[4], (6, other)]
    restored = dict(rows(W.restore_paths(archived, ["stock_code"])))
    assert restored[1] == data[0][1] and restored[2] == data[1][1]
    assert restored[5] == "data/raw/auditor_pdfs/20150101.pdf" and restored[6] == "data/raw/auditor_pdfs/[c9]-[x].pdf"
    assert restored[3] == " " and restored[4] is None


def test_worklist(spark, rows):
    index = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "  "), (4, None), (5, "c")], "stock_code int, pdf_path string")
    codes = spark.createDataFrame([(1,), (1,), (5,), (9,)], "stock_code int")
    assert rows(W.document_worklist(index)) == [("a",), ("b",), ("c",)]
    assert rows(W.document_worklist(index, codes)) == [("a",), ("c",)]


def test_pending(spark, rows):
    def ids(*values):
        return spark.createDataFrame(list(enumerate(values)), "seq long, id string")

    pending, counts = W.pending_list(ids("9", "1", "9", "2", "3"), ids("1", "1"), ids("2", "7"))
    assert [r[1] for r in pending.collect()] == ["9", "9", "3"]
    assert rows(counts) == [(5, 1, 2, 3)]
    summary = spark.createDataFrame(
        [(5, " 4 ", "saved"), (6, "3", "skipped"), (7, "4", "saved"), (8, "1", "saved"), (4, "8", "saved "), (9, "", "saved")],
        "seq long, stock_id string, status string",
    )
    updated, added = W.update_ignore(ids("1", "6"), summary)
    assert rows(updated) == [(0, 0, "1"), (0, 1, "6"), (1, 4, "8"), (1, 5, "4")]
    assert rows(added) == [(2,)]


def test_new_documents(spark, rows):
    docs = spark.createDataFrame([("a_20140101", "qualified opinion"), ("b.txt", "x"), ("c", ""), ("d", "y")], "document_name string, text string")
    done = spark.createDataFrame([("x/b.pdf",), ("d",), (None,)], "document_name string")
    assert rows(R.flag_new_documents(docs, done), "document_name", "report_date", "qualified_opinion") == [("a_20140101", "2014-01-01", 1)]
    assert rows(W.skip_done(docs, done), "document_name") == [("a_20140101",), ("c",)]


def test_paths_with_the_same_stem(spark, rows):
    docs = spark.createDataFrame([("r.txt", "Adverse opinion"), ("s", "")], "document_name string, text string")
    paths = spark.createDataFrame([("a/r.pdf",), ("b/r.pdf",), ("s.pdf",), ("t.pdf",)], "pdf_path string")
    assert rows(R.texts_for_paths(paths, docs)) == [("r", "Adverse opinion"), ("r", "Adverse opinion")]
    assert rows(R.flag_paths(paths, docs), "document_name", "adverse_opinion") == [("r", 1), ("r", 1)]


def test_release_round(spark, rows):
    wrap = lambda i: f'callback({{"stockInfo":[{{"stockId":{i},"code":"{i}","name":"N"}}]}});'
    lookups = spark.createDataFrame([(0, wrap(3)), (1, wrap(1)), (2, wrap(2))], "seq long, body string")
    payloads = spark.createDataFrame(
        [(0, "3", '{"result":"[{\\"T\\":\\"t\\"}]"}'), (1, "2", '{"result":"[]"}'), (2, "1", '{"result":"[{\\"T\\":\\"u\\"}]"}')],
        "seq long, stock_id string, body string",
    )
    ignore = spark.createDataFrame([(0, "1")], "seq long, id string")
    existing = spark.createDataFrame([], "id string")
    got = releases.ingest_releases(lookups, payloads, ignore, existing, "struct<T:string>")
    assert [r["id"] for r in got["pending"].collect()] == ["3", "2"]
    assert rows(got["counts"]) == [(3, 1, 0, 2)]
    assert rows(got["records"]) == [("3", 0, "t")]
    assert rows(got["summary"]) == [(0, "3", "saved", 1), (1, "2", "skipped", 0)]
    assert rows(got["ignore"], "part", "id") == [(0, "1"), (1, "3")]
    assert rows(got["added"]) == [(1,)]


def test_chunks_cover_the_text(spark, rows):
    from ledgerloom.operators import chunks as C

    texts = ["", None, "a" * 10, "abcdefghij" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = rows(C.chunk_texts(df, "k", size=10, overlap=4))
    assert [g[:3] for g in got] == [(0, 0, 0), (2, 0, 0), (3, 0, 0), (3, 1, 6), (3, 2, 12), (3, 3, 18), (3, 4, 24)]
    for key, _, start, chunk in got:
        assert chunk == texts[key][start : start + 10]


def test_votes(spark, rows):
    from ledgerloom.operators import chunks as C

    df = spark.createDataFrame([(1, 0, 2), (1, 1, 1), (1, 1, 1), (2, 1, 3), (2, 0, 1)], "d int, label int, w int")
    assert rows(C.vote(df, "d", "label", "w")) == [(1, 0, 0.5, 1), (2, 1, 0.75, 0)]
