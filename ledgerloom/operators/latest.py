"""One record per key: the latest with ties, or the first in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import left_lookup, spread_join
from ledgerloom.operators.sketches import BITS, key_filter, may_be_key
from ledgerloom.session import settle

# The largest filter of last records, 8 MB; beyond eight million keys more rows pass.
MOST_BITS = 1 << 26


def latest_per_key(df: DataFrame, key: str, by: str) -> DataFrame:
    """Rows that carry the greatest ``by`` of their key; all ties stay.

    The maxima combine before the shuffle and join back as one row per key, so
    even a key with a third of the rows, all tied, is never one task's group.
    Keys whose ``by`` is NULL throughout have no latest record.
    """
    return spread_join(df, _last_per_key(df, key, by), [(key, "_key"), (by, "_last")], "left_semi")


def _last_per_key(df: DataFrame, key: str, by: str) -> DataFrame:
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(by).alias("_last"))
    )


def latest_rows(df: DataFrame, key: str, by: str) -> DataFrame:
    """``latest_per_key`` of wide rows, settled; ``df`` is read twice.

    The maxima come from the key columns alone. A filter of them drops most of the
    other rows where they are read, below the joins that ``df`` is made of; the exact
    join follows.
    """
    last = settle(_last_per_key(df, key, by), "last-records").withColumn("_pair", F.xxhash64("_key", "_last"))
    bits = min(max(BITS, 1 << (8 * last.count()).bit_length()), MOST_BITS)
    words = settle(key_filter(last, "_pair", bits), "last-filter")
    near = df.where(may_be_key(words, F.xxhash64(key, by), bits))
    rows = spread_join(near, last.drop("_pair"), [(key, "_key"), (by, "_last")], "left_semi")
    return settle(rows, "latest-rows")


def latest_join(left: DataFrame, right: DataFrame, on: tuple[str, str], by: str) -> DataFrame:
    """Left join to the latest record(s) of ``right`` per key."""
    return left_lookup(left, latest_per_key(right, on[1], by), [(on[0], on[1])])


def one_per_group(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each group in ``order``, which should be total.

    ``row_number() = 1`` lets every map task drop all but its own first row of
    a group before the shuffle.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def max_per_key(df: DataFrame, key: str, by: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(by).alias(name))
