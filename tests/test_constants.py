"""Fixed values written out, so that the engine and its SQL cannot both be wrong."""

from ledgerloom.functions import text as T
from ledgerloom.operators import pages
from ledgerloom.plans import views


def test_text_constants():
    assert T.START_KEYWORDS == (
        "audit", "opinion", "management", "material uncertainty", "going concern", "emphasis of matter",
    )
    assert T.STOP_KEYWORDS == (
        "financial", "statements", "consolidated", "balance", "income", "notes", "appendix", "schedule",
        "result", "assets", "liabilities", "profit",
    )
    assert (T.MIN_CHARS, T.DIGIT_SHARE, T.TABLE_LINE_CHARS) == (2000, 0.3, 20)
    assert T.OPINION_PATTERNS == {
        "qualified_opinion": r"\bqualified opinion\b",
        "adverse_opinion": r"\badverse opinion\b",
        "disclaimer_of_opinion": r"\bdisclaimer (of )?opinion\b",
        "emphasis_of_matter": r"\bemphasis of matter\b",
        "going_concern": r"material uncertainty (related to|regarding) going concern",
    }


def test_guards_are_beginnings_of_every_match():
    assert [T.fixed_start(p) for p in T.OPINION_PATTERNS.values()] == [
        "qualified opinion", "adverse opinion", "disclaimer ", "emphasis of matter", "material uncertainty ",
    ]
    assert T.fixed_start("colou?r") == "colo"
    assert T.fixed_start("a|b") == "" and T.fixed_start("(a|b)c") == "" and T.fixed_start("ab*") == "a"


def test_view_constants():
    assert (views.FIRST_YEAR, views.FIRST_DATE) == (2014, "2014-01-01")
    assert views.OPINION_COLUMNS == (
        "aof_qualified_op", "aof_adverse_op", "aof_disclaimer_op", "aof_emphasis_op", "aof_material_unc_op",
    )
    assert len(views.SHARED_LISTING_COLUMNS) == 12
    assert len(views.GEM_LISTING_COLUMNS) == 8 and len(views.MAIN_LISTING_COLUMNS) == 6
    assert len(pages.SKIP_PHRASES) == 9 and len(pages.KEEP_PHRASES) == 9
