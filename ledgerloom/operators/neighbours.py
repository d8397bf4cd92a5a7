"""Row-order operators whose groups may be far larger than one task.

A plain ``lag``/``lead`` window sorts a whole group in one task. Here groups of
more than ``width`` rows are cut into ranges of ``width`` positions: a window
then holds one small group or one range, and only the few rows at the range
ends of big groups meet again. Where no group is big, what is left of the plan
is the plain window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import settle

# Positions per window: about a million rows sort comfortably in one task.
WIDTH = 1 << 20

RANGE = "_range"


def big_groups(
    df: DataFrame, keys: list[str], least: int, sizes: DataFrame | None = None
) -> DataFrame | None:
    """``_key_0.., _rows`` of the groups with more than ``least`` rows; None without any.

    Without ``sizes`` the groups are counted here and now, which reads the key
    columns alone.
    """
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    sizes = sizes.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_rows")
    big = settle(sizes.where(F.col("_rows") > least), "big-groups")
    return None if big.isEmpty() else big


def with_group_rows(df: DataFrame, keys: list[str], big: DataFrame) -> DataFrame:
    """Add ``_rows``: the size of a row's group where that is big, else NULL.

    ``big`` is settled, so the planner knows whether it is small enough to send.
    """
    names = [f"_key_{i}" for i in range(len(keys))]
    same = F.lit(True)
    for key, name in zip(keys, names):
        same = same & F.col(key).eqNullSafe(F.col(name))
    return df.join(big, same, "left").drop(*names)


def cut_groups(
    df: DataFrame, keys: list[str], order: list[str], segments: list[str], width: int = WIDTH,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add ``_range``: where a row of a big group lies, NULL in the other groups.

    Rows are in the order ``segments`` then ``order``; ``order[0]`` is a number
    that few rows of a segment and group share. A range is one stretch of
    ``width`` such numbers within a segment, so ranges follow each other.
    ``sizes``, the keys and ``_rows`` per group, saves counting them here.
    """
    big = big_groups(df, keys, width, sizes)
    if big is None:
        return df.withColumn(RANGE, F.lit(None).cast("bigint"))
    place = F.col(order[0]).cast("bigint")
    stretch = F.struct(*segments, (place - F.pmod(place, F.lit(width))).alias("start"))
    cut = F.when(F.col("_rows").isNotNull(), stretch)
    ranged = with_group_rows(df, keys, big).withColumn(RANGE, cut).drop("_rows")
    # Rows that come in partitioned by the keys would pass for ready otherwise.
    return ranged.repartition(*keys, RANGE)


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: list[str],
    back: int = 0,
    ahead: int = 0,
    segments: list[str] | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """Add ``prev_1..prev_back`` and ``next_1..next_ahead``.

    Each is a struct of the ``value`` columns of that neighbour in the same
    group, NULL where there is none. ``order[0]`` is a numeric position; the
    other columns break its ties, and ``segments`` (a file name, say) come
    before it. All of them must be a total order. A frame that is cut already
    is taken as it is and stays cut.
    """
    segments = segments or []
    is_cut = RANGE in df.columns
    packed = F.struct(*value)
    reach = max(back, ahead)
    near = Window.partitionBy(*keys, RANGE).orderBy(*segments, *order)
    far = Window.partitionBy(*keys).orderBy(*segments, *order)
    shifts = {f"prev_{i}": (F.lag, i) for i in range(1, back + 1)}
    shifts |= {f"next_{i}": (F.lead, i) for i in range(1, ahead + 1)}

    here = F.lit(1)
    at_end = F.lag(here, reach).over(near).isNull() | F.lead(here, reach).over(near).isNull()
    cut = df if is_cut else cut_groups(df, keys, order, segments, width)
    ranged = cut.select(
        "*",
        *[shift(packed, i).over(near).alias(name) for name, (shift, i) in shifts.items()],
        at_end.alias("_at_end"),
    )
    # The first and last `reach` rows of every range: all that a row can need
    # from another range, and all rows that need something from one.
    ends = F.col(RANGE).isNotNull() & F.col("_at_end")
    joined_up = ranged.where(ends).withColumns(
        {
            name: F.coalesce(F.col(name), shift(packed, i).over(far))
            for name, (shift, i) in shifts.items()
        }
    )
    found = ranged.where(~ends).unionByName(joined_up).drop("_at_end")
    return found if is_cut else found.drop(RANGE)


def running_last(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    name: str,
    segments: list[str] | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """Add ``name``: the last non-NULL ``value`` at or before each row of its group."""
    segments = segments or []
    is_cut = RANGE in df.columns
    cut = df if is_cut else cut_groups(df, keys, order, segments, width)
    ranged = cut.withColumn("_value", value)
    within = (
        Window.partitionBy(*keys, RANGE)
        .orderBy(*segments, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(RANGE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    place = F.when(F.col("_value").isNotNull(), F.struct(*order))
    carried = (
        ranged.where(F.col(RANGE).isNotNull())
        .groupBy(*keys, RANGE)
        .agg(F.max_by("_value", place).alias("_end"))
        .select(
            *[F.col(k).alias(f"_of_{k}") for k in (*keys, RANGE)],
            F.last("_end", ignorenulls=True).over(earlier).alias("_carry"),
        )
    )
    # NULL is a group like the others.
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in (*keys, RANGE)])
    found = (
        ranged.withColumn("_near", F.last("_value", ignorenulls=True).over(within))
        .join(carried, same, "left")
        .withColumn(name, F.coalesce("_near", "_carry"))
        .drop("_value", "_near", "_carry", *[f"_of_{k}" for k in (*keys, RANGE)])
    )
    return found if is_cut else found.drop(RANGE)
