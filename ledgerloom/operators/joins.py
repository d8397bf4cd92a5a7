"""Matching: inner, left, anti and semi joins, and the match report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Types of which any two have a common one that loses nothing of either key.
COMPARABLE = ((NumericType,), (DateType, TimestampType, TimestampNTZType), (StringType,))


def _suffixed(right: DataFrame, taken: set[str], suffix: str) -> DataFrame:
    return right.select(
        *[F.col(c).alias(c + suffix if c in taken else c) for c in right.columns]
    )


def _common_type(df: DataFrame, left: DataType, right: DataType) -> DataType:
    """The type in which Spark compares both; keys of unlike kinds are an error."""
    if left == right:
        return left
    if not any(isinstance(left, kind) and isinstance(right, kind) for kind in COMPARABLE):
        raise TypeError(
            f"keys of types {left.simpleString()} and {right.simpleString()} do not compare; "
            "bring one over first (cells.key_column makes text a number)"
        )
    both = F.coalesce(F.lit(None).cast(left), F.lit(None).cast(right))
    return df.select(both.alias("key")).schema["key"].dataType


def spread_join(
    left: DataFrame, right: DataFrame, on: list[tuple[Column | str, str]], how: str, branch: bool = True
) -> DataFrame:
    """Join in which NULL keys never shuffle and hot keys stay open to the adaptive skew join.

    ``on`` pairs a left column with a column of ``right``; the right columns
    used as keys are dropped. Keys of different types meet in their common type
    (7 is not 7.5, a day is midnight); text never meets numbers or dates.

    A row with a NULL key matches nothing. Inner and semi joins leave such rows
    out ahead of the shuffle; left and anti joins return them by a union, from
    the task that reads them. Nothing but the keys is computed on, so filters and
    column choices made on the result reach the scans of both branches. The
    branch evaluates ``left`` again, for its NULL keys alone: keep ``left`` near
    its tables or settle it. ``branch=False`` joins all rows at once, which is
    better for keys that are hardly ever NULL.

    A second join key is the hash of the others: neither side comes in
    partitioned as the join needs it, by a grouping below it, say. Both shuffle
    right below the join, and only there can a hot partition be split.
    """
    keys = [F.col(a) if isinstance(a, str) else a for a, _ in on]
    names = [name for _, name in on]
    types = [
        _common_type(left, one.dataType, other.dataType)
        for one, other in zip(left.select(*keys).schema, right.select(*names).schema)
    ]
    keys = [key.cast(kind) for key, kind in zip(keys, types)]
    known = reduce(Column.__and__, [key.isNotNull() for key in keys])
    outer = how in ("left", "left_anti")
    side = left if outer and not branch else left.where(known)
    keyed = side.withColumns(
        {**{f"_l{i}": key for i, key in enumerate(keys)}, "_lspread": F.xxhash64(*keys)}
    )
    right_keys = [F.col(name).cast(kind) for name, kind in zip(names, types)]
    other = right.select(
        *[key.alias(f"_r{i}") for i, key in enumerate(right_keys)],
        F.xxhash64(*right_keys).alias("_rspread"),
        *[c for c in right.columns if c not in names],
    )
    match = F.col("_lspread") == F.col("_rspread")
    for i in range(len(on)):
        match = match & (F.col(f"_l{i}") == F.col(f"_r{i}"))
    helpers = [f"{side}{i}" for i in range(len(on)) for side in ("_l", "_r")]
    joined = keyed.join(other, match, how).drop(*helpers, "_lspread", "_rspread")
    if not outer or not branch:
        return joined
    added = joined.schema[len(left.columns):]
    alone = left.where(~known).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    return joined.union(alone)


def left_lookup(
    left: DataFrame, right: DataFrame, on: list[tuple[Column | str, str]], branch: bool = True
) -> DataFrame:
    """Left join to the columns of ``right`` other than its keys."""
    return spread_join(left, right, on, "left", branch)


def keep_listed(
    left: DataFrame, right: DataFrame, on: list[tuple[Column | str, str]], listed: bool = True
) -> DataFrame:
    """Left rows whose key occurs on the right, or (``listed=False``) does not.

    The right keys are made unique before they shuffle, so a hot key there is
    one row. A NULL key never occurs.
    """
    keys = right.select(*[name for _, name in on]).distinct()
    return spread_join(left, keys, on, "left_semi" if listed else "left_anti")


def join_master(df: DataFrame, master: DataFrame, key: str, suffix: str = "_isino") -> DataFrame:
    """Inner join on ``key``; clashing master columns get the suffix."""
    taken = set(df.columns) - {key}
    return spread_join(df, _suffixed(master, taken, suffix), [(key, key)], "inner")


def match_rows(left: DataFrame, right: DataFrame, on: str, suffix: str = "_right") -> DataFrame:
    """All columns of both sides for rows with equal ``on``."""
    other = _suffixed(right, set(left.columns), suffix)
    return left.join(other, left[on] == other[on + suffix], "inner")


def semi_join(left: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Left rows whose key occurs."""
    return keep_listed(left, keys, [(on, on)])


def unmatched_rows(
    left: DataFrame, right: DataFrame, on: str, columns: list[str] | None = None
) -> DataFrame:
    """Left rows without a partner, NULL keys included.

    With ``columns``: those columns, each combination once.
    """
    alone = keep_listed(left, right, [(on, on)], listed=False)
    return alone if columns is None else alone.select(*columns).distinct()


def semi_join_where(
    left: DataFrame, right: DataFrame, on: tuple[str, str], left_cond: Column, right_cond: Column
) -> DataFrame:
    """``EXISTS`` with a condition on either side, both applied before the join."""
    return keep_listed(left.where(left_cond), right.where(right_cond), [on])


def _side_entities(
    side: str, df: DataFrame, other: DataFrame, on: str, entities: list[str]
) -> DataFrame:
    """``side, entity, value, hit`` for every entity column of one side."""
    known = other.select(on).distinct().withColumn("_hit", F.lit(True))
    pairs = df.select(on, *[e for e in entities if e != on]).distinct()
    flagged = left_lookup(pairs, known, [(on, on)])
    values = F.array(
        *[
            F.struct(F.lit(e).alias("entity"), F.col(e).cast("string").alias("value"))
            for e in entities
        ]
    )
    return flagged.select(
        F.lit(side).alias("side"), F.inline(values), F.col("_hit").isNotNull().alias("hit")
    ).where(F.col("value").isNotNull())


def match_report(
    left: DataFrame, right: DataFrame, on: str,
    left_entities: list[str], right_entities: list[str],
) -> DataFrame:
    """Distinct entities in all, with a partner and without, for both sides.

    An entity with some matched and some unmatched rows counts in both.
    """
    values = _side_entities("left", left, right, on, left_entities).unionByName(
        _side_entities("right", right, left, on, right_entities)
    )
    per_value = values.groupBy("side", "entity", "value").agg(
        F.max("hit").alias("hit"), F.min("hit").alias("all_hit")
    )
    return per_value.groupBy("side", "entity").agg(
        F.count("*").alias("total"),
        F.count_if("hit").alias("matched"),
        F.count_if(~F.col("all_hit")).alias("missing"),
        (F.count_if("hit") / F.count("*")).alias("match_rate"),
    )


def count_distinct(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row of distinct counts, ``{alias: column}``; NULL does not count."""
    return df.agg(*[F.count_distinct(c).alias(alias) for alias, c in columns.items()])
