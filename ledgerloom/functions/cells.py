"""Cell and key clean-up for untyped sheet cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII blanks, including the four separator control characters.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"

_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def strip(col: Column) -> Column:
    """Trim every kind of blank, not the space character alone."""
    return F.btrim(col, F.lit(BLANKS))


def flatten_breaks(col: Column) -> Column:
    """One space for each run of line breaks; the few cells that have any pay for the search."""
    broken = F.contains(col, F.lit("\n")) | F.contains(col, F.lit("\r"))
    return F.when(broken, F.regexp_replace(col, r"[\r\n]+", " ")).otherwise(col)


def blank_quotes(col: Column) -> Column:
    """NULL for a cell that holds nothing but double quotes."""
    return F.when((F.btrim(col, F.lit('"')) != "") | (col == ""), col)


def squeeze_spaces(col: Column) -> Column:
    return F.regexp_replace(col, " {2,}", " ")


def cell(cells: Column, index: int) -> Column:
    """The cell at ``index``, NULL past the end of a short row."""
    return F.get(cells, F.lit(index))


def clean_cells(cells: Column, quotes: bool = True) -> Column:
    """Flatten line breaks in all cells and, by default, blank quote-only cells."""
    flat = F.transform(cells, flatten_breaks)
    # A step of its own: in one, each use of the flat cell would flatten it again.
    return F.transform(flat, blank_quotes) if quotes else flat


def filled_cells(cells: Column) -> Column:
    return F.size(F.filter(cells, lambda c: c.isNotNull()))


def to_key(col: Column) -> Column:
    """Numeric text to BIGINT, fractions cut off; NULL when it is not a number.

    Whole numbers are read as integers so that keys above 2**53 stay exact.
    """
    text = strip(col.cast("string"))
    number = F.when(text.rlike(_NUMBER), text)
    return F.coalesce(text.try_cast("bigint"), number.try_cast("double").try_cast("bigint"))


def key_column(df: DataFrame, name: str) -> Column:
    """``to_key`` of a column, or the column as BIGINT where it is a whole number already."""
    if df.schema[name].dataType.typeName() in ("byte", "short", "integer", "long"):
        return F.col(name).cast("bigint")
    return to_key(F.col(name))
