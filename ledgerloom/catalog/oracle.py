"""The registered queries as DuckDB SQL over the given tables."""

from __future__ import annotations

import re

from ledgerloom.functions import text as T
from ledgerloom.catalog.shapes import LOWER, REPORT_WORDS
from ledgerloom.plans.views import (
    GEM_LISTING_COLUMNS,
    MAIN_LISTING_COLUMNS,
    OPINION_COLUMNS,
    SHARED_LISTING_COLUMNS,
)

ORACLE: dict[str, str] = {}


# Expressions


def _isin(key: str) -> str:
    return f"nullif('I' || lpad(CAST({key} AS VARCHAR), 9, '0'), 'I000000007')"


def _gvkey(key: str) -> str:
    return f"lpad(CAST({key} AS VARCHAR), 6, '0')"


def _quarter(date: str) -> str:
    return f"CAST(year({date}) AS VARCHAR) || 'Q' || CAST(quarter({date}) AS VARCHAR)"


def _day(date: str) -> str:
    return f"strftime({date}, '%Y-%m-%d')"


def _type(*ordinary: str) -> str:
    listed = ", ".join(f"'{o}'" for o in ordinary)
    return f"CASE WHEN p_type IN ({listed}) THEN 'ORD SH' ELSE p_type END"


_YEAR = "'20' || lpad(replace(source, 'src', ''), 2, '0')"
_NAME = f"'rep_' || {_YEAR} || '0630_' || CAST(doc_id AS VARCHAR)"


def _report_text() -> str:
    text = "text"
    for word, put in REPORT_WORDS.items():
        text = f"replace({text}, '{word}', '{put}')"
    return text


def _quarters(table: str, key: str, date: str) -> str:
    return f"""SELECT {_gvkey(key)} gvkey, {_isin(key)} isin, 'FIRM ' || CAST({key} AS VARCHAR) conm,
        {_day(date)} datadate, {_quarter(date)} datacqtr, 'F' || {_quarter(date)} datafqtr,
        CAST(year({date}) AS INT) fyearq, CAST(quarter({date}) AS INT) fqtr"""


def _filters(status: str) -> str:
    return f"""CASE WHEN {status} IN ('O', 'A') THEN 170 ELSE 180 END exchg,
        CASE WHEN {status} IN ('P', 'N') THEN 'FS' ELSE 'INDL' END indfmt,
        'I' popsrc, 'C' consol, 'HIST_STD' datafmt"""


def _words(keywords) -> str:
    return r"(?i)\b(?:" + "|".join(keywords) + r")\b"


def _isin_rows(key: str, table: str, nation: str, first: int, company: str, kind: str) -> str:
    return f"""SELECT 'isin_' || n_name || '.xlsx' source_file, {key} + {first} row_idx, {company} company,
        ' ISIN' || CAST({key} AS VARCHAR) isin, {key} stock_code, {kind} stock_type,
        'Place of' place_of_incorporation, n_name national_agency
        FROM {table} JOIN nation ON {nation} = n_nationkey"""


# Result names, old name first.
FIRM = ["gvkey", "isin", "conm", "datadate", "datacqtr", "datafqtr", "fyearq", "fqtr"]
LISTING_NAMES = {
    "stock_code": "hkex_stock_code", "stock_type": "hkex_stock_type", "company": "hkex_full_name"
}
INDEX_NAMES = {
    "stock_code": "har_stock_code", "announcement_date": "har_announcement_date",
    "hyperlink": "har_hyperlink", "pdf_path": "har_pdf_path",
}
FLAG_NAMES = {
    "document_name": "aof_document_id", "report_date": "aof_report_date",
    "qualified_opinion": "aof_qualified_op", "adverse_opinion": "aof_adverse_op",
    "disclaimer_of_opinion": "aof_disclaimer_op", "emphasis_of_matter": "aof_emphasis_op",
    "going_concern": "aof_material_unc_op",
}


def _renamed(names: dict[str, str], table: str) -> str:
    return ", ".join(f"{table}.{old} AS {new}" for old, new in names.items())


def _documents(flags: str) -> str:
    """Flags with what is known of their report and its firm."""
    firm = {k: v for k, v in LISTING_NAMES.items() if k != "stock_code"}
    known = f"""SELECT i.document_name, {_renamed(INDEX_NAMES, "i")}, {_renamed(firm, "l")}
        FROM report_index AS i LEFT JOIN master AS l USING (stock_code)"""
    return f"""SELECT known.* EXCLUDE (document_name), {_renamed(FLAG_NAMES, "flags")}
        FROM ({flags}) AS flags LEFT JOIN ({known}) AS known USING (document_name)"""


def _with_reports(recent: str) -> str:
    """Dataset rows from 1998 on of codes with a report for which ``recent`` holds."""
    return f"""SELECT * FROM dataset WHERE cs_fyearq >= 1998
        AND hkex_stock_code IN (SELECT har_stock_code FROM document_set WHERE {recent})"""


def _latest(board: str) -> str:
    """Rows of each code's last listing date, ties included."""
    return f"""SELECT * FROM {board}
        QUALIFY listing_date = max(listing_date) OVER (PARTITION BY stock_code)"""


def _both_boards(sql: str) -> str:
    """One statement over each board, named in a column."""
    return " UNION ALL ".join(
        f"SELECT *, '{name}' AS board FROM ({sql.format(board=f'hkex_{name}')})" for name in ("gem", "main")
    )


_KIND = "CASE WHEN c_mktsegment <> 'BUILDING' THEN 'ORD SH' END"
_MASTER = f"upper(p_name) company_isino, {_isin('p_partkey')} isin"
_CO_NAME = "upper(p_name) || ' ' || p_brand"

# Shapes, in the order they depend on each other

SHAPES = {
    "hkex_main": f"""SELECT 'Main_' || CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' source_file,
        p_partkey stock_code, p_name company, {_day('l_shipdate')} prospectus_date,
        strftime(l_shipdate, '%Y-%m-01') listing_date, nullif(l_returnflag, 'N') sponsors,
        'RA ' || l_suppkey reporting_accountant, 'V ' || l_linenumber valuers,
        l_extendedprice subscription_price, l_quantity funds_raised_hk,
        nullif(l_discount, 0.0) funds_raised_intl, nullif(l_tax, 0.0) funds_raised_sg, {_MASTER},
        {_type('SMALL', 'PROMO', 'ECONOMY')} stock_type, p_type place_of_incorporation,
        p_brand national_agency, {_CO_NAME} hkex_co_name
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F'""",
    "hkex_gem": f"""SELECT 'GEM_' || CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' source_file,
        strftime(l_shipdate, '%Y-%m-01') listing_date, p_partkey stock_code,
        p_name || ' ' || p_brand company, l_extendedprice offer_price,
        l_quantity subscription_ratio, l_discount funds_raised, l_tax shrout_at_listing,
        p_retailprice mcap_at_listing, p_brand industry,
        nullif(l_returnflag, 'A') place_of_incorporation, 'M ' || l_linenumber listing_method,
        nullif(l_returnflag, 'R') sponsors, 'GA ' || l_suppkey reporting_accountant, {_MASTER},
        {_type('SMALL', 'PROMO', 'LARGE')} stock_type, p_type place_of_incorporation_isino,
        p_brand national_agency, {_CO_NAME} hkex_co_name
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'O'""",
    "hkex_isin": f"""SELECT upper(p_name) company, {_isin('p_partkey')} isin, p_partkey stock_code,
        {_type('SMALL', 'MEDIUM')} stock_type, p_type place_of_incorporation,
        p_brand national_agency, {_CO_NAME} hkex_co_name FROM part""",
    "funda_q_isin": _quarters("lineitem", "l_partkey", "l_shipdate") + " FROM lineitem",
    "funda_q_170": _quarters("orders", "o_custkey", "o_orderdate") + " FROM orders",
    "g_funda": f"""SELECT {_gvkey('o_custkey')} gvkey, {_isin('o_custkey')} isin,
        'FIRM ' || CAST(o_custkey AS VARCHAR) conm, {_day('o_orderdate')} datadate,
        CAST(year(o_orderdate) AS INT) fyear, {_filters('o_orderstatus')} FROM orders""",
    "g_fundq": _quarters("lineitem", "l_partkey", "l_shipdate")
    + f", {_filters('l_returnflag')} FROM lineitem",
    "funda_a": "SELECT gvkey, isin, conm, datadate, fyear FROM g_funda",
    "classified": f"""SELECT l_partkey hkex_stock_code, l_partkey cs_gvkey,
        {_quarter('l_shipdate')} cs_datacqtr, CAST(quarter(l_shipdate) AS INT) cs_fqtr,
        CAST(l_discount > 0.05 AS INT) aof_qualified_op, CAST(l_tax > 0.04 AS INT) aof_adverse_op,
        CAST(l_quantity > 40 AS INT) aof_disclaimer_op, CAST(l_quantity < 10 AS INT) aof_emphasis_op,
        CAST(l_linenumber > 4 AS INT) aof_material_unc_op, nullif(l_returnflag, 'N') aof_comments
        FROM lineitem""",
    "report_index": f"""SELECT doc_id stock_code, 'Firm ' || CAST(doc_id AS VARCHAR) listed_company_name,
        CASE WHEN lang = 'en' THEN {_YEAR} || '-06-30' ELSE '30/06/' || {_YEAR} END announcement_date,
        '/docs/' || {_NAME} || '.pdf?v=' || lang hyperlink,
        'data/raw/auditor_pdfs/' || {_NAME} || '.pdf' pdf_path, {_NAME} document_name
        FROM documents""",
    "opinion_flags": f"""SELECT {_NAME} document_name, {_YEAR} || '-06-30' report_date,
        quality qualified_opinion, toxic adverse_opinion,
        CAST(n_chars > 2000 AS INT) disclaimer_of_opinion, CAST(lang = 'en' AS INT) emphasis_of_matter,
        CAST(n_chars < 500 AS INT) going_concern FROM labels JOIN documents USING (doc_id)""",
    "reports": f"SELECT {_NAME} document_name, {_report_text()} AS text FROM documents",
    "offers": """SELECT l_partkey stock_code, l_orderkey * 8 + l_linenumber seq, l_suppkey tie,
        l_extendedprice funds_raised,
        CASE l_returnflag WHEN 'A' THEN '(a)' WHEN 'R' THEN ' (b)' ELSE '(c) ' END offer_location,
        'FIRM ' || CAST(l_partkey AS VARCHAR) company FROM lineitem""",
    "envelopes": r"""SELECT event_id seq, CAST(event_id AS VARCHAR) stock_id, event_type FROM events""",
    "lookups": """SELECT o_orderkey seq, o_custkey, o_orderstatus FROM orders
        WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority <> '5-LOW'""",
    "mapping_rows": """
        SELECT seq, 0 AS position, o_custkey stock_code, CAST(o_custkey AS VARCHAR) stock_id,
            'N' || CAST(o_custkey AS VARCHAR) AS name FROM lookups
        UNION ALL
        SELECT seq, 1, o_custkey + 7900, 'x' || CAST(o_custkey AS VARCHAR), 'M' FROM lookups""",
    "mapping": """SELECT * EXCLUDE (rn) FROM (SELECT seq, position, stock_code, stock_id, name,
            CASE WHEN stock_code BETWEEN 8000 AND 8999 THEN 'GEM' ELSE 'SEHK' END market,
            row_number() OVER (PARTITION BY stock_id ORDER BY seq, position) rn
            FROM mapping_rows) WHERE rn = 1""",
    "label_responses": f"""SELECT {_NAME} filename, n_chars text_len, lang, quality, toxic
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "release_summary": """SELECT event_id seq, CAST(user_id AS VARCHAR) stock_id,
        CASE event_type WHEN 'purchase' THEN 'saved' WHEN 'error' THEN 'failed' ELSE 'skipped' END status
        FROM events""",
    "listed": " UNION ALL ".join(
        f"SELECT stock_code, isin, company, stock_type FROM {board}"
        for board in ("hkex_main", "hkex_gem", "hkex_isin")
    ),
    "master": """SELECT stock_code, isin, max(company) AS company, any_value(stock_type) AS stock_type
        FROM listed WHERE stock_type = 'ORD SH' GROUP BY stock_code, isin""",
    "dataset": f"""SELECT {_renamed(LISTING_NAMES, "l")}, {", ".join(f"q.{c} AS cs_{c}" for c in FIRM)}
        FROM funda_q_isin AS q LEFT JOIN master AS l USING (isin)""",
    "document_set": _documents("SELECT * FROM opinion_flags"),
    "merged": """SELECT stock_code, seq, tie, company,
            CASE WHEN loc NOT IN ('(b)', '(c)') THEN funds_raised END funds_raised_hk,
            CASE WHEN next_loc = '(b)' THEN next_funds END funds_raised_intl,
            CASE WHEN next_loc = '(c)' THEN next_funds END funds_raised_sg
        FROM (SELECT *, trim(offer_location) loc,
                lead(trim(offer_location)) OVER w next_loc, lead(funds_raised) OVER w next_funds,
                row_number() OVER w rn
            FROM offers WINDOW w AS (PARTITION BY stock_code ORDER BY seq, tie, funds_raised))
        WHERE loc NOT IN ('(b)', '(c)') OR rn = 1""",
    "main_sheet": """SELECT 'Main_' || CAST(year(o_orderdate) AS VARCHAR) || '.xlsx' source_file,
        o_orderkey + 2 row_idx,
        CASE o_orderpriority WHEN '1-URGENT' THEN o_custkey WHEN '2-HIGH' THEN o_custkey
            WHEN '3-MEDIUM' THEN o_custkey ELSE NULL END code,
        'Firm ' || CAST(o_custkey AS VARCHAR) || ' Ltd' company,
        strftime(o_orderdate, '%Y-%m-%d') prospectus_date, strftime(o_orderdate, '%Y-%m-%d') listing_date,
        CASE WHEN o_orderstatus <> 'P' THEN 'Sponsor ' || CAST(o_custkey AS VARCHAR) END sponsors,
        CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) funds_raised,
        CAST(o_orderkey AS VARCHAR) subscription_price,
        CASE o_orderstatus WHEN 'O' THEN '(a)' WHEN 'F' THEN '(b)' ELSE ' (c) ' END offer_location,
        trim(CASE o_orderstatus WHEN 'O' THEN '(a)' WHEN 'F' THEN '(b)' ELSE ' (c) ' END) loc
        FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus = 'P'""",
    # The fill as a walk over each sheet, two rows of state.
    "main_numbered": """SELECT source_file, row_idx, code, loc,
        row_number() OVER (PARTITION BY source_file ORDER BY row_idx) n FROM main_sheet""",
    "main_walk": """SELECT source_file, n, row_idx, code AS filled, CAST(NULL AS BIGINT) AS above, loc
            FROM main_numbered WHERE n = 1
        UNION ALL
        SELECT m.source_file, m.n, m.row_idx,
            CASE WHEN m.loc IN ('(b)', '(c)') AND w.loc = '(a)' THEN w.filled
                WHEN m.loc = '(c)' AND w.loc = '(b)' AND m.n > 2 THEN w.above ELSE m.code END,
            w.filled, m.loc
        FROM main_walk w JOIN main_numbered m ON m.source_file = w.source_file AND m.n = w.n + 1""",
    "main_bronze": """SELECT s.source_file, s.row_idx, w.filled stock_code, s.company, s.prospectus_date,
        s.listing_date, s.sponsors, CAST(NULL AS VARCHAR) reporting_accountant, 'V' valuers,
        s.funds_raised, s.subscription_price, s.offer_location
        FROM main_sheet s JOIN main_walk w ON s.source_file = w.source_file AND s.row_idx = w.row_idx
        WHERE w.filled IS NOT NULL""",
    "gem_bronze": """SELECT 'GEM_' || n_name || '.xlsx' source_file, c_custkey + 11 row_idx,
        'D' || CAST(c_custkey AS VARCHAR) listing_date, c_custkey stock_code, c_name || ' Limited' company,
        '1.5' offer_price, '2' subscription_ratio, 'F' || CAST(c_custkey AS VARCHAR) funds_raised,
        'S' shrout_at_listing, CAST(NULL AS VARCHAR) mcap_at_listing, c_mktsegment industry,
        'P' place_of_incorporation, 'M' listing_method, 'Sp' sponsors,
        'A' || CAST(c_custkey AS VARCHAR) reporting_accountant
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE n_regionkey <> 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""",
    "isin_above": _isin_rows("c_custkey", "customer", "c_nationkey", 3, "c_name", _KIND),
    "isin_below": _isin_rows(
        "s_suppkey", "supplier", "s_nationkey", LOWER + 3, "s_name || '  '", "'ORD SH'"
    ),
    "built_isin": """SELECT b.company, b.isin, b.stock_code, b.stock_type, b.place_of_incorporation,
        b.national_agency, n.stock_type hkex_co_name
        FROM (SELECT * FROM isin_above UNION ALL SELECT * FROM isin_below) b
        LEFT JOIN isin_above n ON b.stock_code = n.stock_code""",
    "built_offers": """SELECT * EXCLUDE (row_idx, funds_raised, offer_location, loc, next_loc, next_funds, rn),
            CASE WHEN loc NOT IN ('(b)', '(c)') THEN funds_raised END funds_raised_hk,
            CASE WHEN next_loc = '(b)' THEN next_funds END funds_raised_intl,
            CASE WHEN next_loc = '(c)' THEN next_funds END funds_raised_sg
        FROM (SELECT *, trim(offer_location) loc,
                lead(trim(offer_location)) OVER w next_loc, lead(funds_raised) OVER w next_funds,
                row_number() OVER w rn
            FROM main_bronze WINDOW w AS (PARTITION BY stock_code ORDER BY source_file, row_idx))
        WHERE loc NOT IN ('(b)', '(c)') OR rn = 1""",
    "built_main": """SELECT m.*, h.company company_isino, h.isin, h.stock_type, h.place_of_incorporation,
        h.national_agency, h.hkex_co_name FROM built_offers m JOIN built_isin h ON m.stock_code = h.stock_code""",
    "built_gem": """SELECT g.* EXCLUDE (row_idx), h.company company_isino, h.isin, h.stock_type,
        h.place_of_incorporation place_of_incorporation_isino, h.national_agency, h.hkex_co_name
        FROM gem_bronze g JOIN built_isin h ON g.stock_code = h.stock_code""",
    "built_master": """SELECT stock_code, isin, max(company) company, stock_type FROM (
        SELECT stock_code, isin, company, stock_type FROM built_main
        UNION ALL SELECT stock_code, isin, company, stock_type FROM built_gem
        UNION ALL SELECT stock_code, isin, company, stock_type FROM built_isin)
        WHERE stock_type = 'ORD SH' GROUP BY stock_code, isin, stock_type""",
    "report_lines": rf"""SELECT document_name, line, n - 1 AS line_no FROM (
        SELECT document_name, unnest(lines) AS line, generate_subscripts(lines, 1) n FROM (
            SELECT document_name, CASE WHEN ascii_text = '' THEN []
                ELSE string_split(regexp_replace(ascii_text, '\n$', ''), chr(10)) END lines
            FROM (SELECT document_name, regexp_replace(text, '[^\x00-\x7F]', '', 'g') ascii_text
                FROM reports)))""",
    "marked_lines": rf"""SELECT document_name, line_no, line,
        regexp_matches(line, '{_words(T.START_KEYWORDS)}') starts,
        regexp_matches(line, '{_words(T.STOP_KEYWORDS)}') stops,
        length(regexp_replace(line, '[^0-9]', '', 'g')) digits FROM report_lines""",
    # Blocks as a walk over each report: copy, skip, or the count of a kept region.
    "sized_lines": """SELECT m.*, length(line) + CASE WHEN line_no < last THEN 1
            ELSE CAST(ends_open = 0 AS INT) END size
        FROM marked_lines m JOIN (SELECT document_name, max(line_no) AS last FROM marked_lines
            GROUP BY 1) USING (document_name)
        JOIN (SELECT document_name, CAST(right(text, 1) <> chr(10) AS INT) ends_open FROM reports)
            USING (document_name)""",
    "line_walk": f"""SELECT document_name, CAST(-1 AS BIGINT) line_no, 'copy' AS state,
            CAST(0 AS BIGINT) held, false AS kept FROM reports
        UNION ALL
        SELECT l.document_name, l.line_no,
            CASE WHEN w.state = 'hold' THEN CASE WHEN w.held + l.size < {T.MIN_CHARS} THEN 'hold' ELSE 'copy' END
                WHEN w.state = 'skip' AND NOT l.starts THEN 'skip'
                WHEN w.state = 'skip' THEN CASE WHEN l.size < {T.MIN_CHARS} THEN 'hold' ELSE 'copy' END
                WHEN l.stops AND NOT l.starts THEN 'skip' ELSE 'copy' END,
            CASE WHEN w.state = 'hold' THEN w.held + l.size
                WHEN w.state = 'skip' AND l.starts THEN l.size ELSE 0 END,
            CASE WHEN w.state = 'hold' THEN true WHEN w.state = 'skip' THEN l.starts
                ELSE NOT (l.stops AND NOT l.starts) END
        FROM line_walk w JOIN sized_lines l
            ON l.document_name = w.document_name AND l.line_no = w.line_no + 1""",
    "block_texts": """SELECT r.document_name, coalesce(k.text, '') AS text FROM reports r LEFT JOIN (
            SELECT document_name, string_agg(line || CASE WHEN size > length(line) THEN chr(10) ELSE '' END,
                '' ORDER BY line_no) AS text
            FROM sized_lines JOIN (SELECT document_name, line_no FROM line_walk WHERE kept)
                USING (document_name, line_no) GROUP BY 1) k ON k.document_name = r.document_name""",
    "clean_lines": f"""SELECT document_name, row_number() OVER (PARTITION BY document_name ORDER BY line_no) n,
            trim(line) AS line, starts, stops,
            regexp_full_match(trim(line), '[A-Z0-9 \\-''(),.]+') AND length(trim(line)) >= 3 AS capitals
        FROM marked_lines WHERE trim(line) <> ''
            AND NOT (digits > {T.DIGIT_SHARE} * length(trim(line)) AND length(trim(line)) > {T.TABLE_LINE_CHARS})""",
    "clean_texts": """SELECT r.document_name, coalesce(c.text, '') AS text FROM reports r LEFT JOIN (
            SELECT document_name, string_agg(line, chr(10) ORDER BY n) AS text
            FROM clean_lines GROUP BY 1) c ON c.document_name = r.document_name""",
    "sliced": r"""SELECT document_name, trim(regexp_replace(regexp_replace(regexp_replace(kept,
            '[ \t\x1f]+', ' ', 'g'), ' +(\n|$)', '\1', 'g'), '\n{3,}', chr(10) || chr(10), 'g'),
            ' ' || chr(10)) AS text
        FROM (SELECT b.document_name, CASE WHEN b.text = '' THEN c.text ELSE b.text END kept
            FROM block_texts b JOIN clean_texts c ON b.document_name = c.document_name)""",
    "kept_pages": """SELECT CAST(conv_id AS VARCHAR) document_name, turn page_no, text FROM conversations
        WHERE NOT ((contains(lower(text), 'ation') OR contains(lower(text), 'que'))
            AND NOT (contains(lower(text), 'the ') OR contains(lower(text), 'les ')))""",
}


def _needs(sql: str) -> list[str]:
    """Shapes that the SQL names, with those they name in turn, in order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in words & SHAPES.keys() - found:
            found.add(name)
            todo.append(SHAPES[name])
    return [name for name in SHAPES if name in found]


def oracle(name: str, sql: str) -> None:
    names = _needs(sql)
    parts = ", ".join(f"{n} AS ({SHAPES[n]})" for n in names)
    ORACLE[name] = f"WITH RECURSIVE {parts} {sql}" if names else sql


# Entity master, datasets, exports

oracle("entity_master", "SELECT * FROM master")
oracle("firm_dataset", "SELECT * FROM dataset")
oracle("document_dataset", "SELECT * FROM document_set")
_RECENT = "har_announcement_date >= '2014-01-01' OR aof_report_date >= '2014-01-01'"
oracle("dataset_with_documents", _with_reports(_RECENT))
oracle("dataset_with_documents_by_date", _with_reports(
    "try_strptime(har_announcement_date, ['%Y-%m-%d', '%d/%m/%Y']) >= TIMESTAMP '2014-01-01'"
    " OR try_strptime(aof_report_date, '%Y-%m-%d') >= TIMESTAMP '2014-01-01'"
))
oracle("recent_dataset", "SELECT * FROM dataset WHERE cs_fyearq >= 1999")
oracle("recent_documents", "SELECT * FROM document_set WHERE aof_report_date >= '2014-01-01'")

_FIRM = FIRM
_OPINION = ["hkex_stock_code", *OPINION_COLUMNS, "aof_comments"]


def _first(table: str, keys: str, order: list[str], where: str = "true") -> str:
    """One row per group, the first in an order with NULL before all else."""
    by = ", ".join(c if c.endswith("LAST") else f"{c} NULLS FIRST" for c in order)
    return f"""SELECT * FROM {table} WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {by}) = 1"""


_QUARTER_ORDER = ["datadate DESC NULLS LAST", "isin", *[c for c in _FIRM if c not in ("datadate", "isin")]]
oracle("classified_firm_quarters", f"""SELECT {", ".join("quarters." + c for c in _FIRM)},
    {", ".join("opinions." + c for c in _OPINION)},
    {", ".join(f"coalesce(growth.{c}, main.{c}) AS hk_{c}" for c in SHARED_LISTING_COLUMNS)},
    {", ".join(f"growth.{c} AS gem_{c}" for c in GEM_LISTING_COLUMNS)},
    {", ".join(f"main.{c} AS main_{c}" for c in MAIN_LISTING_COLUMNS)}
    FROM ({_first("funda_q_isin", "gvkey, datacqtr", _QUARTER_ORDER)}) AS quarters
    LEFT JOIN ({_first("classified", "cs_gvkey, cs_datacqtr", _OPINION, "cs_fqtr = 4")}) AS opinions
        ON opinions.cs_gvkey = TRY_CAST(quarters.gvkey AS BIGINT)
        AND opinions.cs_datacqtr = quarters.datacqtr
    LEFT JOIN ({_latest("hkex_gem")}) AS growth ON growth.stock_code = opinions.hkex_stock_code
    LEFT JOIN ({_latest("hkex_main")}) AS main ON main.stock_code = opinions.hkex_stock_code""")
oracle("isin_keys", """SELECT isin FROM (SELECT isin FROM hkex_main WHERE stock_type = 'ORD SH'
    UNION SELECT isin FROM hkex_gem WHERE stock_type = 'ORD SH'
    UNION SELECT isin FROM hkex_isin WHERE stock_type = 'ORD SH') WHERE isin IS NOT NULL ORDER BY 1""")
oracle("stock_code_keys", """SELECT stock_code FROM hkex_main WHERE stock_type = 'ORD SH'
    UNION SELECT stock_code FROM hkex_gem WHERE stock_type = 'ORD SH'
    UNION SELECT stock_code FROM hkex_isin WHERE stock_type = 'ORD SH'""")
oracle("board_codes_repeated", """SELECT stock_code FROM (SELECT stock_code, stock_type FROM hkex_gem
    UNION ALL SELECT stock_code, stock_type FROM hkex_main)
    WHERE stock_type = 'ORD SH' AND stock_code <> 0""")
oracle("listing_rows", """SELECT stock_code, isin, company, stock_type FROM hkex_main
    UNION ALL SELECT stock_code, isin, company, stock_type FROM hkex_gem
    UNION ALL SELECT stock_code, isin, company, stock_type FROM hkex_isin""")
_INDUSTRIAL = "indfmt = 'INDL' AND popsrc = 'I' AND consol = 'C' AND datafmt = 'HIST_STD'"
oracle("fundamentals_annual", f"""SELECT gvkey, isin, conm, datadate, fyear FROM g_funda
    WHERE exchg = 170 AND {_INDUSTRIAL}""")
oracle("fundamentals_quarterly", f"""SELECT {", ".join(_FIRM)} FROM g_fundq
    WHERE exchg = 170 AND {_INDUSTRIAL}""")
oracle("fundamentals_by_isin", f"""SELECT * FROM g_fundq WHERE {_INDUSTRIAL} AND isin IN (
    SELECT isin FROM hkex_main WHERE stock_type = 'ORD SH' AND isin IS NOT NULL
    UNION SELECT isin FROM hkex_gem WHERE stock_type = 'ORD SH' AND isin IS NOT NULL
    UNION SELECT isin FROM hkex_isin WHERE stock_type = 'ORD SH' AND isin IS NOT NULL)""")

# Matching

oracle("unmatched_firms", """SELECT DISTINCT f.gvkey, f.isin, f.conm FROM funda_q_170 f
    LEFT JOIN master h ON f.isin = h.isin WHERE h.isin IS NULL""")
oracle("unmatched_listings", """SELECT DISTINCT h.stock_code, h.isin, h.company, h.stock_type
    FROM master h LEFT JOIN funda_q_170 f ON h.isin = f.isin WHERE f.isin IS NULL""")
_RIGHT = """h.company, h.isin isin_hkex, h.stock_code, h.stock_type, h.place_of_incorporation,
    h.national_agency, h.hkex_co_name"""
oracle("matched_rows", f"SELECT f.*, {_RIGHT} FROM funda_a f JOIN hkex_isin h ON f.isin = h.isin")
oracle("reconciliation_matched_firms", f"""SELECT * EXCLUDE (rn) FROM (SELECT f.*, {_RIGHT},
    row_number() OVER (PARTITION BY f.gvkey ORDER BY f.isin, f.conm, f.datadate, f.fyear,
        h.company, h.stock_code, h.stock_type, h.place_of_incorporation, h.national_agency,
        h.hkex_co_name) rn
    FROM funda_a f JOIN hkex_isin h ON f.isin = h.isin) WHERE rn = 1""")
oracle("reconciliation_totals", """SELECT count(DISTINCT isin) total_unique_isins,
    count(DISTINCT gvkey) total_unique_gvkeys FROM funda_a""")
oracle("reconciliation_matched", """SELECT count(DISTINCT f.isin) matched_unique_isins,
    count(DISTINCT f.gvkey) matched_unique_gvkeys FROM funda_a f JOIN hkex_isin h ON f.isin = h.isin""")
_ALONE_LEFT = "FROM funda_a f LEFT JOIN hkex_isin h ON f.isin = h.isin WHERE h.isin IS NULL"
_ALONE_RIGHT = "FROM hkex_isin h LEFT JOIN funda_a f ON h.isin = f.isin WHERE f.isin IS NULL"
oracle("reconciliation_missing_left_rows", f"SELECT f.* {_ALONE_LEFT}")
oracle("reconciliation_missing_left_keys", f"SELECT DISTINCT f.gvkey, f.isin {_ALONE_LEFT}")
oracle("reconciliation_missing_left", f"""SELECT count(DISTINCT f.isin) missing_isins,
    count(DISTINCT f.gvkey) missing_gvkeys {_ALONE_LEFT}""")
oracle("reconciliation_missing_right_rows", f"SELECT h.* {_ALONE_RIGHT}")
oracle("reconciliation_missing_right_keys", f"SELECT DISTINCT h.isin {_ALONE_RIGHT}")
oracle("reconciliation_missing_right", f"SELECT count(DISTINCT h.isin) missing_isins {_ALONE_RIGHT}")


def _report_row(side: str, entity: str, left: str, right: str) -> str:
    hit = f"EXISTS (SELECT 1 FROM {right} r WHERE r.isin = l.isin)"
    return f"""SELECT '{side}' AS side, '{entity}' AS entity, count(DISTINCT {entity}) total,
        count(DISTINCT CASE WHEN hit THEN {entity} END) matched,
        count(DISTINCT CASE WHEN NOT hit THEN {entity} END) missing,
        count(DISTINCT CASE WHEN hit THEN {entity} END) / count(DISTINCT {entity}) match_rate
        FROM (SELECT l.*, {hit} hit FROM {left} l)"""


oracle("match_report", " UNION ALL ".join([
    _report_row("left", "isin", "funda_q_170", "master"),
    _report_row("left", "gvkey", "funda_q_170", "master"),
    _report_row("right", "isin", "master", "funda_q_170"),
    _report_row("right", "stock_code", "master", "funda_q_170"),
]))
oracle("yearly_panel", """SELECT fyearq AS year, count(DISTINCT gvkey) firms, count(*) observations,
    avg(CAST(fqtr < 4 AS INT)) AS share FROM funda_q_isin GROUP BY fyearq""")

# Latest records and one row per group

oracle("last_listing_dates", _both_boards("""SELECT stock_code, max(listing_date) AS max_listing_date
    FROM {board} GROUP BY stock_code"""))
oracle("latest_listings", _both_boards(f"SELECT {', '.join(SHARED_LISTING_COLUMNS)} FROM ({_latest('{board}')})"))
oracle("latest_listing_join", _both_boards(f"""SELECT i.*, b.listing_date, b.company AS listed_company, b.sponsors
    FROM hkex_isin AS i LEFT JOIN ({_latest('{board}')}) AS b USING (stock_code)"""))
oracle("first_row_per_quarter", f"""SELECT {", ".join(_FIRM)} FROM (SELECT *, row_number() OVER (
    PARTITION BY gvkey, datacqtr ORDER BY datadate DESC, isin, conm) rn FROM funda_q_isin) WHERE rn = 1""")
oracle("year_end_opinions", """SELECT q.gvkey, q.datacqtr, q.datadate, o.aof_qualified_op
    FROM funda_q_170 q LEFT JOIN (SELECT cs_gvkey, cs_datacqtr, max(aof_qualified_op) aof_qualified_op
        FROM classified WHERE cs_fqtr = 4 GROUP BY 1, 2) o
    ON TRY_CAST(q.gvkey AS BIGINT) = o.cs_gvkey AND q.datacqtr = o.cs_datacqtr""")

# Offers and boards

oracle("merged_offers", "SELECT * FROM merged")
oracle("merged_offers_onto_parents", """SELECT * FROM (
    WITH placed AS (SELECT *, trim(offer_location) AS loc, last_value(CASE WHEN trim(offer_location)
            NOT IN ('(b)', '(c)') THEN rn END IGNORE NULLS) OVER (PARTITION BY stock_code ORDER BY rn
            ROWS UNBOUNDED PRECEDING) AS parent
        FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY seq, tie, funds_raised) AS rn FROM offers)),
    received AS (SELECT stock_code, parent, max(funds_raised) FILTER (WHERE loc = '(b)') AS intl,
            max(funds_raised) FILTER (WHERE loc = '(c)') AS sg
        FROM placed WHERE loc IN ('(b)', '(c)') AND parent IS NOT NULL GROUP BY 1, 2)
    SELECT p.stock_code, p.seq, p.tie, p.company,
        CASE WHEN p.loc NOT IN ('(b)', '(c)') THEN p.funds_raised END AS funds_raised_hk,
        r.intl AS funds_raised_intl, r.sg AS funds_raised_sg
    FROM placed p LEFT JOIN received r ON r.stock_code = p.stock_code AND r.parent = p.rn
    WHERE p.loc NOT IN ('(b)', '(c)') OR p.parent IS NULL)""")
oracle("main_board_silver", """SELECT m.*, h.company company_isino, h.isin, h.stock_type,
    h.place_of_incorporation, h.national_agency, h.hkex_co_name
    FROM merged m JOIN hkex_isin h ON m.stock_code = h.stock_code""")
oracle("growth_board_silver", _both_boards("""SELECT g.source_file, g.stock_code, g.company, g.place_of_incorporation,
    g.listing_date, g.sponsors, h.company company_isino, h.isin, h.stock_type,
    h.place_of_incorporation place_of_incorporation_isino, h.national_agency, h.hkex_co_name
    FROM {board} g JOIN hkex_isin h ON g.stock_code = h.stock_code"""))
oracle("isin_master", f"""SELECT b.*, c_name hkex_co_name FROM (
    SELECT * EXCLUDE (hkex_co_name) FROM hkex_isin
    UNION ALL SELECT upper(s_name), {_isin('s_suppkey')}, s_suppkey, 'WARRANT', NULL, NULL FROM supplier) b
    LEFT JOIN customer ON b.stock_code = c_custkey""")

# Sheets

oracle("main_board_bronze", "SELECT * FROM main_bronze")
oracle("growth_board_bronze", "SELECT * FROM gem_bronze")
oracle("growth_board_rejects", """SELECT 'GEM_' || n_name || '.xlsx' source_file,
    'fewer than 13 named columns' reason FROM nation WHERE n_regionkey = 0""")


_BROKEN = "'isin_' || n_name || '.xlsx' AS source_file"
oracle("sheet_rejects", f"""SELECT DISTINCT 'main' AS sheet, 'Main_1995.xlsx' AS source_file,
        'no row with a key' AS reason FROM orders WHERE year(o_orderdate) = 1995
    UNION ALL SELECT 'gem', 'GEM_' || n_name || '.xlsx', 'fewer than 13 named columns'
        FROM nation WHERE n_regionkey = 0
    UNION ALL SELECT 'agency', {_BROKEN}, 'table 1 not found' FROM nation WHERE n_regionkey = 0
    UNION ALL SELECT 'agency legend', {_BROKEN}, CASE n_regionkey WHEN 0 THEN 'table 1 not found'
        WHEN 1 THEN 'table 1 has no end' ELSE 'agency table not found' END FROM nation WHERE n_regionkey < 3
    UNION ALL SELECT 'exchange', {_BROKEN}, CASE n_regionkey WHEN 0 THEN 'table 1 not found'
        WHEN 1 THEN 'table 1 has no end' ELSE 'table 2 not found' END FROM nation WHERE n_regionkey < 3
    UNION ALL SELECT 'names', {_BROKEN}, 'table 1 not found' FROM nation WHERE n_regionkey = 0""")
oracle("isin_list_first_table", "SELECT * FROM isin_above")
oracle("isin_list_second_table", "SELECT * FROM isin_below")
oracle("national_agencies", f"""SELECT 'isin_' || n_name || '.xlsx' source_file,
    s_suppkey + {LOWER + 3} row_idx, s_name national_agency, 'ISIN' || CAST(s_suppkey AS VARCHAR) description
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
oracle("short_names", f"""SELECT 'isin_' || n_name || '.xlsx' source_file, c_custkey + 3 row_idx,
    c_custkey stock_code, stock_type hkex_co_name
    FROM (SELECT *, {_KIND} stock_type FROM customer) JOIN nation ON c_nationkey = n_nationkey""")
oracle("table_bounds", f"""SELECT 'isin_' || n_name || '.xlsx' source_file, CAST(2 AS BIGINT) header_1,
    CAST({LOWER} AS BIGINT) stop_1, CAST({LOWER + 2} AS BIGINT) header_2,
    CAST({2 * LOWER} AS BIGINT) stop_2 FROM nation""")
oracle("stock_type_legends", """SELECT p_partkey, 0 AS position, p_type stock_type, p_name description FROM part
    UNION ALL SELECT p_partkey, 1, p_brand, 'a - b (c)' FROM part""")
_BOARD = """source_file, stock_code, company, prospectus_date, listing_date, sponsors,
    reporting_accountant, valuers, funds_raised, subscription_price, offer_location"""
_GEM_ONLY = ("offer_price", "subscription_ratio", "shrout_at_listing", "mcap_at_listing", "industry",
             "place_of_incorporation", "listing_method")
oracle("combined_boards", f"""SELECT {_BOARD}, {", ".join("NULL " + c for c in _GEM_ONLY)} FROM main_bronze
    UNION ALL SELECT source_file, stock_code, company, NULL, listing_date, sponsors,
    reporting_accountant, NULL, funds_raised, NULL, NULL, {", ".join(_GEM_ONLY)} FROM gem_bronze""")

oracle("built_main_board", "SELECT * FROM built_main")
oracle("built_growth_board", "SELECT * FROM built_gem")
oracle("built_entity_master", "SELECT * FROM built_master")

# Report texts

oracle("ascii_texts", r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS text FROM documents")
oracle("texts_without_table_lines", r"""SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY n)
        FILTER (WHERE line <> '' AND NOT (length(regexp_replace(line, '[^0-9]', '', 'g'))
            > 0.02 * length(line) AND length(line) > 20)), '') AS text
    FROM (SELECT doc_id, trim(unnest(lines)) AS line, generate_subscripts(lines, 1) n
        FROM (SELECT doc_id, string_split(text, chr(10)) lines FROM documents)) GROUP BY doc_id""")
oracle("keyword_lines", """SELECT document_name, CAST(line_no AS INT) line_no, CAST(starts AS INT) AS starts, CAST(stops AS INT) AS stops,
    CASE WHEN length(line) > 0 THEN round(digits / length(line), 6) ELSE 0.0 END digit_share
    FROM marked_lines""")
oracle("texts_without_stop_blocks", "SELECT document_name, text FROM block_texts")
oracle("heading_sections", f"""SELECT r.document_name, CASE WHEN s.first IS NULL THEN c.text ELSE trim(s.text,
        ' ' || chr(10)) END AS text
    FROM reports r JOIN clean_texts c ON c.document_name = r.document_name LEFT JOIN (
        SELECT document_name, any_value(f) AS first,
            string_agg(line, chr(10) ORDER BY n) FILTER (WHERE n < stop OR (short AND before < {T.MIN_CHARS})) AS text
        FROM (SELECT *, max(CASE WHEN n < stop THEN before + length(line) + 1 END)
                OVER (PARTITION BY document_name) < {T.MIN_CHARS} AS short
            FROM (SELECT l.*, f, coalesce(min(CASE WHEN n > f AND ((stops AND NOT starts) OR capitals)
                        THEN n END) OVER d, 1e9) AS stop,
                    coalesce(sum(length(line) + 1) OVER (PARTITION BY document_name ORDER BY n
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
                FROM clean_lines l JOIN (SELECT document_name, min(n) f FROM clean_lines WHERE starts
                    GROUP BY 1) USING (document_name) WHERE n >= f
                WINDOW d AS (PARTITION BY document_name)))
        GROUP BY document_name) s ON s.document_name = r.document_name""")
oracle("sliced_reports", "SELECT * FROM sliced")

_FOLDED = r"lower(regexp_replace(text, '\s+', ' ', 'g'))"


def _flags(source: str, extra: str = "") -> str:
    flags = ", ".join(
        f"CAST(regexp_matches(folded, '{pattern}') AS INT) {name}"
        for name, pattern in T.OPINION_PATTERNS.items()
    )
    return f"""SELECT document_name, {_date('document_name')} report_date, {flags}{extra}
        FROM (SELECT document_name, {_FOLDED} folded FROM {source} WHERE length(text) > 0)"""


def _date(name: str) -> str:
    digits = f"regexp_extract({name}, '[0-9]{{8}}')"
    return f"""CASE WHEN {digits} = '' THEN '' ELSE {digits}[1:4] || '-' || {digits}[5:6] || '-' ||
        {digits}[7:8] END"""


oracle("opinion_phrase_flags", _flags("sliced"))
oracle("opinion_flags_in_sql", _flags("sliced"))
oracle("unclear_opinions", f"""SELECT *, CAST(qualified_opinion + adverse_opinion + disclaimer_of_opinion <> 1
    AS INT) unclear FROM ({_flags("reports")})""")
oracle("folded_texts", r"""SELECT doc_id, lower(regexp_replace(regexp_replace(text, '[^\x00-\x7F]', '', 'g'),
    '\s+', ' ', 'g')) AS text FROM documents""")
oracle("decoded_texts", "SELECT doc_id, text FROM documents")
oracle("texts_for_paths", "SELECT document_name, text FROM reports WHERE length(text) > 0")
oracle("document_branch", _documents(_flags("sliced")))
oracle("flags_for_codes", f"""SELECT * FROM ({_flags("sliced")}) WHERE document_name IN (
    SELECT document_name FROM report_index WHERE stock_code IN (SELECT doc_id FROM labels WHERE quality = 1))""")
oracle("incremental_flags", f"""SELECT * FROM opinion_flags UNION ALL BY NAME SELECT * FROM ({_flags("sliced")})
    WHERE document_name NOT IN (SELECT document_name FROM opinion_flags)""")
oracle("double_keys_joined", """SELECT l_orderkey, l_linenumber, l_quantity / 2 AS half, n_name
    FROM lineitem LEFT JOIN nation ON n_nationkey = l_quantity / 2""")
oracle("new_document_flags", f"""SELECT * FROM ({_flags("reports")})
    WHERE document_name NOT IN (SELECT document_name FROM opinion_flags)""")
oracle("streamed_flags", _flags("sliced"))

# Names and codes

oracle("report_dates", f"SELECT doc_id, {_date('text')} report_date FROM documents")
oracle("file_name_parts", """SELECT stock_code, document_name || '.pdf' file_name, document_name stem,
    '.pdf' AS extension FROM report_index""")
_ARCHIVE = """'[c' || CAST(stock_code AS VARCHAR) || ']-[' || regexp_extract(document_name, '[0-9]{8}') || ']-['
    || regexp_extract(document_name, '[0-9]{8}(.*)$', 1) || ']-[' || document_name || '].pdf'"""
oracle("archive_names", f"SELECT stock_code, {_ARCHIVE} AS name FROM report_index")
oracle("original_names", f"""SELECT stock_code, document_name || '.pdf' AS name, {_ARCHIVE} name_twice
    FROM report_index""")
_BY_DATE = "split_part(announcement_date || '.pdf', '/', -1)"
oracle("archived_index", f"""SELECT r.stock_code, r.listed_company_name, r.announcement_date, r.hyperlink,
    m.new_path AS pdf_path, r.document_name FROM report_index r JOIN (
        SELECT announcement_date, 'data/processed/auditor_pdfs/[c' || CAST(min(stock_code) AS VARCHAR)
            || ']-[00000000]-[' || regexp_extract({_BY_DATE}, '^(.*)\\.pdf$', 1) || ']-['
            || regexp_extract({_BY_DATE}, '^(.*)\\.pdf$', 1) || '].pdf' new_path
        FROM report_index GROUP BY announcement_date) m ON m.announcement_date = r.announcement_date""")
oracle("restored_index", "SELECT * FROM report_index")
oracle("ids_from_names", """SELECT event_id, CASE WHEN event_type <> 'error'
    THEN CAST(event_id AS VARCHAR) END id FROM events""")
oracle("market_classes", """SELECT o_orderkey, CASE WHEN o_orderkey >= 8000 AND o_orderkey <= 8999
    THEN 'GEM' ELSE 'SEHK' END market FROM orders""")

# Payloads and work lists

_RECORDS = """SELECT stock_id, 0 AS position, stock_id NEWS_ID, event_type TITLE FROM {0}
    WHERE event_type IN ('click', 'view')
    UNION ALL SELECT stock_id, 1, stock_id, event_type FROM {0} WHERE event_type = 'click'"""
oracle("envelope_records", _RECORDS.format("envelopes"))
_STATUS = """CASE WHEN event_type IN ('click', 'view') THEN 'saved' WHEN event_type = 'error' THEN 'skipped'
    ELSE 'failed' END"""
_ROWS = "CAST(CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END AS INT)"
oracle("run_summary", f"SELECT stock_id, {_STATUS} status, {_ROWS} row_count FROM envelopes")
oracle("summary_counts", f"""SELECT {_STATUS} status, count(*) AS keys, CAST(sum({_ROWS}) AS BIGINT) records
    FROM envelopes GROUP BY 1""")
oracle("lookup_rows", """SELECT *, CASE WHEN stock_code BETWEEN 8000 AND 8999 THEN 'GEM' ELSE 'SEHK' END market
    FROM mapping_rows""")
oracle("stock_id_mapping", "SELECT * FROM mapping")
_ARRIVED = """(SELECT * FROM envelopes WHERE stock_id IN (SELECT stock_id FROM mapping)
    AND stock_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)
    AND stock_id NOT IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings))"""
oracle("release_round_records", _RECORDS.format(_ARRIVED))
oracle("release_round_ignore", f"""SELECT CAST(0 AS INT) part, s_suppkey seq, CAST(s_suppkey AS VARCHAR) id
    FROM supplier UNION ALL SELECT 1, seq, stock_id FROM {_ARRIVED} WHERE event_type IN ('click', 'view')""")
_PENDING = """FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    AND doc_id NOT IN (SELECT vec_id FROM embeddings)"""
oracle("pending_ids", f"SELECT doc_id seq, CAST(doc_id AS VARCHAR) id {_PENDING} ORDER BY 1")
oracle("pending_counts", f"""SELECT (SELECT count(*) FROM documents) total_full,
    (SELECT count(DISTINCT doc_id) FROM labels) total_ignore,
    (SELECT count(DISTINCT vec_id) FROM embeddings) total_existing,
    (SELECT count(*) {_PENDING}) total_pending""")
_NEW = """SELECT stock_id, min(seq) seq FROM release_summary WHERE status = 'saved'
    AND stock_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier) GROUP BY 1"""
oracle("ignore_update", f"""SELECT CAST(0 AS INT) part, s_suppkey seq, CAST(s_suppkey AS VARCHAR) id FROM supplier
    UNION ALL SELECT 1, seq, stock_id FROM ({_NEW})""")
oracle("ignore_update_count", f"SELECT count(*) added FROM ({_NEW})")
oracle("document_worklist", "SELECT DISTINCT pdf_path FROM report_index WHERE trim(pdf_path) <> ''")
oracle("document_worklist_for_codes", """SELECT DISTINCT pdf_path FROM report_index
    WHERE stock_code IN (SELECT doc_id FROM labels) AND trim(pdf_path) <> ''""")


def _labels(min_chars: int) -> str:
    error = f"""CASE WHEN text_len < {min_chars} THEN 'Insufficient text'
        WHEN quality IS NULL THEN 'No response after retries'
        WHEN lang = 'de' THEN 'JSON parse failed' END"""
    return f"""SELECT filename, error, CASE WHEN error IS NULL THEN quality + toxic + 1 END opinion_type,
        CASE WHEN error IS NULL THEN toxic ELSE 1 END is_uncertain,
        CASE WHEN error IS NULL THEN quality ELSE 0 END going_concern, 0 AS emphasis_of_matter
        FROM (SELECT *, {error} AS error FROM label_responses)"""


oracle("normalized_labels", _labels(300))
oracle("label_summary", f"""SELECT count(*) FILTER (WHERE opinion_type = 1) qualified,
    count(*) FILTER (WHERE opinion_type = 2) adverse, count(*) FILTER (WHERE opinion_type = 3) disclaimer,
    CAST(sum(is_uncertain) AS BIGINT) uncertain, CAST(sum(going_concern) AS BIGINT) going_concern,
    CAST(sum(emphasis_of_matter) AS BIGINT) emphasis_of_matter
    FROM ({_labels(100)}) WHERE error IS NULL""")

# Pages

oracle("kept_pages", "SELECT * FROM kept_pages")
oracle("joined_pages", """SELECT document_name, CAST(coalesce(begins, 0) // 200 AS INT) AS part,
    string_agg(text, chr(10) ORDER BY page_no) AS text
    FROM (SELECT *, sum(length(text) + 1) OVER (PARTITION BY document_name ORDER BY page_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS begins FROM kept_pages) GROUP BY 1, 2""")
oracle("checked_pages", """SELECT *, CASE WHEN text_len < 400 THEN 'Insufficient text' END error FROM (
    SELECT document_name, count(*) pages, length(string_agg(text, chr(10) ORDER BY page_no)) text_len
    FROM kept_pages GROUP BY 1)""")
_LISTS = r"""(SELECT page_id, row_no, regexp_extract(item, '<a href="([^"]*)">', 1) link,
        regexp_extract(item, '<a href="[^"]*">([^<]*)</a>', 1) label
    FROM (SELECT page_id, unnest(items) item, generate_subscripts(items, 1) - 1 row_no
        FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1),
            '<li>(.*?)</li>', 1) items FROM pages)))"""
oracle("html_list_rows", f"SELECT page_id, CAST(row_no AS INT) row_no, label cells, link FROM {_LISTS} WHERE row_no > 0")
oracle("html_report_index", f"""SELECT label stock_code, CAST(NULL AS VARCHAR) listed_company_name,
    CAST(NULL AS VARCHAR) announcement_date, link hyperlink,
    'data/raw/auditor_pdfs/' || link[2:] pdf_path,
    regexp_replace(link[2:], '^(.+)\\.[^.]*$', '\\1') document_name
    FROM {_LISTS} WHERE row_no > 0""")
oracle("harvested_links", f"""SELECT l.page_id, CAST(l.row_no AS INT) AS position,
    regexp_extract(p.url, '^[a-z]+://[^/?#]*') || l.link url, l.link[2:] file_name
    FROM {_LISTS} l JOIN pages p ON p.page_id = l.page_id WHERE lower(l.link) LIKE '%n'""")

# Chunks

oracle("document_chunks", """SELECT doc_id, CAST(n AS INT) AS chunk_no, CAST(n * 800 AS INT) AS start,
    substr(text, CAST(n * 800 + 1 AS INT), 1000) AS chunk
    FROM (SELECT doc_id, text, unnest(range(greatest(
        CAST(ceil((length(text) - 200) / 800.0) AS BIGINT), 1))) AS n FROM documents)""")
_ENTRIES = """SELECT vec_id // 7 AS document, vec_id, CAST(unnest(embedding) AS DOUBLE) AS x,
    generate_subscripts(embedding, 1) AS place FROM embeddings"""
oracle("top_chunks", f"""WITH sums AS (SELECT document, vec_id, sqrt(sum(x * x)) AS size,
        sum(x) FILTER (place = 1) AS first, sum(CASE WHEN place <= 32 THEN x ELSE -x END) / sqrt(64) AS halves,
        sum(x) / sqrt(64) AS total FROM ({_ENTRIES}) GROUP BY 1, 2),
    scores AS (SELECT document, vec_id, 'first' AS category, round(first / size, 6) AS score FROM sums
        UNION ALL SELECT document, vec_id, 'halves', round(halves / size, 6) FROM sums
        UNION ALL SELECT document, vec_id, 'all', round(total / size, 6) FROM sums)
    SELECT document, category, CAST(row_number() OVER best AS INT) AS rank, vec_id, score FROM scores
    WINDOW best AS (PARTITION BY document, category ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= 2""")
oracle("nearest_chunks", """SELECT query_id, CAST(row_number() OVER best AS INT) AS rank, vec_id, score FROM (
        SELECT q.vec_id AS query_id, v.vec_id, round(list_dot_product(q.e, v.e)
            / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))), 6) AS score
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 50 = 0) q,
            (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) v)
    WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= 5""")
oracle("voted_labels", """WITH totals AS (SELECT vec_id // 7 AS document, label, CAST(sum(vec_id % 3 + 1) AS BIGINT) AS w
        FROM embeddings GROUP BY 1, 2)
    SELECT document, arg_max(label, w * 1000000 - label) AS label, round(max(w) / sum(w), 6) AS share,
        CAST(round(max(w) / sum(w), 6) <= 0.5 AS INT) AS unclear
    FROM totals GROUP BY document""")

# Samples and previews

oracle("document_sample", """SELECT doc_id, lang, n_chars FROM documents
    ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100""")
oracle("document_preview", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 10")

# Files

oracle("csv_table_round_trip", "SELECT doc_id, text, lang FROM documents")
oracle("quoted_records", """SELECT doc_id, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines
    FROM documents""")
oracle("table_replaced_from_itself", """SELECT o_orderkey, o_custkey, o_totalprice,
        (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0) AS reported
    FROM orders WHERE o_orderkey % 3 <> 0""")
oracle("order_positions", """SELECT l_orderkey, count(*) AS items, CAST(coalesce(sum(count(*)) OVER (
        ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS items_before
    FROM lineitem GROUP BY l_orderkey""")
oracle("replaced_table", """SELECT count(*) stored, CAST(sum(o_custkey) AS BIGINT) key_sum, count(*) reported
    FROM orders""")
oracle("key_list_round_trip", """SELECT rank() OVER (ORDER BY l_suppkey) - 1 AS seq,
    CAST(l_suppkey AS VARCHAR) AS id FROM (SELECT DISTINCT l_suppkey FROM lineitem)""")
oracle("release_files_round_trip", "SELECT * FROM release_summary")
oracle("document_files_round_trip", """SELECT CAST(doc_id AS VARCHAR) AS document_name, coalesce(text, '') AS text,
    CAST(NULL AS VARCHAR) AS error FROM documents""")
oracle("landed_sheets", """SELECT CAST(c_custkey AS VARCHAR) || '|' || c_name || '|-|' || c_mktsegment || ',|'
    || (SELECT string_agg(CAST(range AS VARCHAR), '|' ORDER BY range) FROM range(40)) AS cells,
    1 AS in_order FROM customer""")


def _cells(export: str, columns: str, source: str) -> str:
    shown = ", ".join(
        f"'{c}=' || coalesce(nullif(CAST({c} AS VARCHAR), ''), '-')" for c in sorted(columns.split())
    )
    return f"SELECT '{export}' AS export, concat_ws('|', {shown}) AS line FROM ({source})"


_DATASET = "hkex_stock_code hkex_stock_type hkex_full_name " + " ".join(f"cs_{c}" for c in FIRM)
_DOCUMENTS = (
    "har_stock_code har_announcement_date har_hyperlink har_pdf_path hkex_stock_type hkex_full_name "
    "aof_document_id aof_report_date aof_qualified_op aof_adverse_op aof_disclaimer_op aof_emphasis_op "
    "aof_material_unc_op"
)
oracle("export_set_contents", " UNION ALL ".join([
    _cells("hkex_dataset", _DATASET, "SELECT * FROM dataset WHERE cs_fyearq >= 1998"),
    _cells("hkex_document_dataset", _DOCUMENTS, "SELECT * FROM document_set WHERE aof_report_date >= '2014-01-01'"),
    _cells("hkex_dataset_hkex_document_exists", _DATASET, """SELECT * FROM dataset hd
        WHERE cs_fyearq >= 1998 AND EXISTS (SELECT 1 FROM document_set doc
            WHERE doc.har_stock_code = hd.hkex_stock_code
            AND (doc.har_announcement_date >= '2014-01-01' OR doc.aof_report_date >= '2014-01-01'))"""),
    _cells("hkex_isin", "company isin stock_code stock_type place_of_incorporation national_agency hkex_co_name",
           "SELECT * FROM hkex_isin"),
    _cells("non_match_funda_q_170", "gvkey isin conm", """SELECT DISTINCT gvkey, isin, conm FROM funda_q_170 f
        WHERE NOT EXISTS (SELECT 1 FROM master h WHERE h.isin = f.isin)"""),
    _cells("non_match_hkex_isin", "stock_code isin company stock_type", """SELECT * FROM master h
        WHERE NOT EXISTS (SELECT 1 FROM funda_q_170 f WHERE f.isin = h.isin)"""),
]))
oracle("export_set_rows", """SELECT 'hkex_dataset' AS export, count(*) AS rows FROM dataset WHERE cs_fyearq >= 1998
    UNION ALL SELECT 'hkex_document_dataset', count(*) FROM document_set WHERE aof_report_date >= '2014-01-01'
    UNION ALL SELECT 'hkex_dataset_hkex_document_exists', count(*) FROM dataset hd
        WHERE cs_fyearq >= 1998 AND EXISTS (SELECT 1 FROM document_set doc
            WHERE doc.har_stock_code = hd.hkex_stock_code
            AND (doc.har_announcement_date >= '2014-01-01' OR doc.aof_report_date >= '2014-01-01'))
    UNION ALL SELECT 'hkex_isin', count(*) FROM hkex_isin
    UNION ALL SELECT 'non_match_funda_q_170', count(DISTINCT (gvkey, isin, conm)) FROM funda_q_170 f
        WHERE NOT EXISTS (SELECT 1 FROM master h WHERE h.isin = f.isin)
    UNION ALL SELECT 'non_match_hkex_isin', count(*) FROM master h
        WHERE NOT EXISTS (SELECT 1 FROM funda_q_170 f WHERE f.isin = h.isin)""")
