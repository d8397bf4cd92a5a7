"""Small classifications of codes, dates and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The numbers reserved for the growth board.
GROWTH_BOARD_FIRST = 8000
GROWTH_BOARD_LAST = 8999


def market_class(
    code: Column, first: int = GROWTH_BOARD_FIRST, last: int = GROWTH_BOARD_LAST
) -> Column:
    return F.when(code.between(first, last), F.lit("GEM")).otherwise(F.lit("SEHK"))


def on_or_after(date: Column, start: str, formats: tuple[str, ...] = ()) -> Column:
    """Is a text date at or after ``start``?

    Dates compare as text unless ``formats`` are given; then the first format
    that reads the value decides, and an unreadable value is NULL.
    """
    if not formats:
        return date >= F.lit(start)
    parsed = F.coalesce(*[F.try_to_date(date, f) for f in formats])
    return parsed >= F.to_date(F.lit(start))


def is_unclear(*opinions: Column) -> Column:
    """1 unless exactly one of the exclusive opinion flags is set."""
    total = sum((F.coalesce(o.cast("int"), F.lit(0)) for o in opinions), F.lit(0))
    return (total != 1).cast("int")
