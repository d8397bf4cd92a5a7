"""Report text: clean-up, slicing and phrase flags.

A report is one value, so everything here works on the whole text of one row
with JVM regular expressions. Loops over lines are possessive and searches
inside a line lazy, which keeps them linear and off the call stack. A text that
is itself computed belongs in a column of its own first, as the steps in
``operators.reports`` do, since an expression may be used more than once here.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.cells import BLANKS, strip

# Heading words, the least size of a kept region, opinion phrases.
START_KEYWORDS = (
    "audit",
    "opinion",
    "management",
    "material uncertainty",
    "going concern",
    "emphasis of matter",
)
STOP_KEYWORDS = (
    "financial",
    "statements",
    "consolidated",
    "balance",
    "income",
    "notes",
    "appendix",
    "schedule",
    "result",
    "assets",
    "liabilities",
    "profit",
)
MIN_CHARS = 2000
OPINION_PATTERNS = {
    "qualified_opinion": r"\bqualified opinion\b",
    "adverse_opinion": r"\badverse opinion\b",
    "disclaimer_of_opinion": r"\bdisclaimer (of )?opinion\b",
    "emphasis_of_matter": r"\bemphasis of matter\b",
    "going_concern": r"material uncertainty (related to|regarding) going concern",
}
DIGIT_SHARE = 0.3
TABLE_LINE_CHARS = 20

# Line ends besides \n; \r\n is one line end.
_OTHER_ENDS = ("\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e")
_OTHER_BLANKS = ("\t", "\x1f")

_ENDS = r"\n\r\x0b\x0c\x1c-\x1e"


def _words(keywords) -> str:
    """Any keyword as whole words; the first letters are tried as one class."""
    heads = "".join(sorted({re.escape(k[0]) for k in keywords}))
    return rf"\b(?=[{heads}])(?:" + "|".join(re.escape(k) for k in keywords) + r")\b"


def has_keyword(line: Column, keywords) -> Column:
    """Does the line hold one of the keywords as whole words, in any case?"""
    return line.rlike("(?i)" + _words(keywords))


def remove_non_ascii(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def _replace_each(text: Column, old, new: str) -> Column:
    for part in old:
        text = F.replace(text, F.lit(part), F.lit(new))
    return text


def has_other_ends(text: Column) -> Column:
    return text.rlike("[" + "".join(_OTHER_ENDS[1:]) + "]")


def unify_line_ends(text: Column) -> Column:
    """All line ends as ``\\n``; most texts have no others and pass as they are."""
    return F.when(has_other_ends(text), _replace_each(text, _OTHER_ENDS, "\n")).otherwise(text)


def text_lines(text: Column) -> Column:
    """The lines as an array; a final line end opens no further line."""
    body = F.regexp_replace(unify_line_ends(text), r"\n\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n"))


def digit_share(line: Column) -> Column:
    size = F.length(line)
    return F.when(size > 0, F.regexp_count(line, F.lit("[0-9]")) / size).otherwise(F.lit(0.0))


def remove_table_lines(
    text: Column, share: float = DIGIT_SHARE, min_chars: int = TABLE_LINE_CHARS
) -> Column:
    """Stripped, non-blank lines without those that are long and mostly digits."""
    lines = F.transform(F.split(unify_line_ends(text), "\n"), strip)
    kept = F.filter(
        lines, lambda s: (s != "") & ~((F.length(s) > min_chars) & (digit_share(s) > share))
    )
    return F.array_join(kept, "\n")


def _stop_blocks(start, stop, min_chars: int, line_start: str, in_line: str, line_end: str) -> str:
    """Pattern of a stop line, the lines skipped after it, and (group 1) the kept region."""
    starts = rf"(?={in_line}*?{_words(start)})"
    no_start = rf"(?!{in_line}*?{_words(start)})"
    stops = rf"(?={in_line}*?{_words(stop)})"
    stop_line = rf"{line_start}{stops}{no_start}{in_line}*+{line_end}?+"
    skipped = rf"(?:{no_start}{in_line}*+{line_end})*+(?:{no_start}{in_line}++\z)?+"
    region = rf"({starts}(?:[\s\S]{{{min_chars - 1}}}{in_line}*+{line_end}?+|[\s\S]*+))?"
    return stop_line + skipped + region


def remove_stop_blocks(
    text: Column, start=START_KEYWORDS, stop=STOP_KEYWORDS, min_chars: int = MIN_CHARS
) -> Column:
    """Drop each block from a stop line up to the next start line.

    The region that starts there is kept for at least ``min_chars`` characters,
    rounded up to whole lines, whatever lines it holds. A line with both kinds
    of keyword opens no block; a block with no later start line ends the text.
    Texts that use ``\\n`` alone take a faster form of the same pattern; texts
    without a stop keyword stay as they are.
    """
    plain = "(?imd)" + _stop_blocks(start, stop, min_chars, "^", ".", r"\n")
    # Start of the text, or just after a line end but not between \r and \n.
    after_end = rf"(?:\A|(?<=[{_ENDS}])(?<!\r(?=\n)))"
    mixed = "(?i)" + _stop_blocks(
        start, stop, min_chars, after_end, f"[^{_ENDS}]", rf"(?:\r\n|[{_ENDS}])"
    )
    return (
        F.when(~has_keyword(text, stop), text)
        .when(has_other_ends(text), F.regexp_replace(text, mixed, "$1"))
        .otherwise(F.regexp_replace(text, plain, "$1"))
    )


def from_first_start(cleaned: Column, start=START_KEYWORDS) -> Column:
    """What begins with the first start line of a text without table lines; '' without one."""
    return F.regexp_extract(cleaned, rf"(?imd)^(?=.*?{_words(start)})(?s:.*+)", 0)


def to_section_end(tail: Column, start=START_KEYWORDS, stop=STOP_KEYWORDS) -> Column:
    """The lines of ``tail`` before the next stop line or line in capitals."""
    stop_line = rf"(?=.*?{_words(stop)})(?!.*?{_words(start)})"
    capitals = r"(?-i:[A-Z0-9 \-'(),.]{3,}+(?=\n|\z))"
    return F.regexp_extract(tail, rf"(?id)\A.*+(?:\n(?!{capitals}|{stop_line}).*+)*+\n?", 0)


def leading_lines(tail: Column, min_chars: int = MIN_CHARS) -> Column:
    """The fewest whole lines with ``min_chars`` characters; '' when there are fewer."""
    return F.regexp_extract(tail, rf"(?d)\A(?s:.{{{min_chars - 1}}}).*+\n?", 0)


def tidy_lines(text: Column) -> Column:
    """One space per run of blanks, no trailing blanks, at most one empty line in a row."""
    spaced = _replace_each(unify_line_ends(text), _OTHER_BLANKS, " ")
    spaced = F.replace(F.regexp_replace(spaced, " {2,}", " "), F.lit(" \n"), F.lit("\n"))
    return strip(F.regexp_replace(spaced, r"\n{3,}", "\n\n"))


def fold_text(text: Column) -> Column:
    """Lower case, each run of blanks one space."""
    return F.lower(F.regexp_replace(text, f"[{BLANKS}]+", " "))


def fixed_start(pattern: str) -> str:
    """Plain text that every match of a lower-case pattern starts with; '' when unknown."""
    depth = 0
    for at, char in enumerate(pattern):
        depth += (char == "(") - (char == ")")
        if char == "|" and not depth:
            return ""
    found = re.match(r"(?:\\b)?([a-z0-9 ]*)(.?)", pattern)
    return found[1][:-1] if found[2] and found[2] in "?*{" else found[1]


def phrase_flag(folded: Column, pattern: str) -> Column:
    """1 when the pattern occurs, in any case, in an already folded text.

    The pattern is tried only on texts that hold its fixed beginning.
    """
    if pattern != pattern.lower():
        return folded.rlike("(?i)" + pattern).cast("int")
    start = fixed_start(pattern)
    found = folded.rlike(pattern)
    if start:
        found = F.contains(folded, F.lit(start)) & found
    return found.cast("int")


def decode_text(content: Column) -> Column:
    """Bytes to text: UTF-8 when valid, else Latin-1."""
    as_text = content.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.decode(content, "ISO-8859-1"))
