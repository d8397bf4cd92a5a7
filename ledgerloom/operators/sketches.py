"""Bloom filters of keys, made by aggregates, that drop rows in the task that reads them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a filter, whatever the number of keys, and bits set per key. A million
# keys let about one in two hundred others pass; far more keys let all pass, which
# costs their way through the join and nothing else.
BITS = 1 << 24
PROBES = 3
WORD = 63  # bits used of a long


def _places(key: Column, bits: int, probes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(probes)]


def key_filter(keys: DataFrame, key: str, bits: int = BITS, probes: int = PROBES) -> DataFrame:
    """One row with ``filter``, an array of longs: the bits of all keys that are not NULL."""
    spots = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits, probes))).alias("spot"))
    words = spots.select(
        F.floor(F.col("spot") / WORD).alias("word"), F.expr(f"shiftleft(1L, cast(spot % {WORD} AS INT))").alias("bit")
    ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    size = bits // WORD + 1
    # Every word once, in order: a fixed number of rows, whatever the keys.
    every = keys.sparkSession.range(size).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    whole = every.unionByName(words.select("word", "bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return whole.agg(F.transform(ordered, lambda w: w["bits"]).alias("filter"))


def may_be_key(filter_row: DataFrame, key: Column, bits: int = BITS, probes: int = PROBES) -> Column:
    """False for most keys that are not in the filter, and for NULL; true for all that are."""
    words = filter_row.scalar()

    def is_set(spot: Column) -> Column:
        word = F.get(words, F.floor(spot / WORD))
        return F.call_function("getbit", word, F.pmod(spot, F.lit(WORD)).cast("int")) == 1

    hit = reduce(Column.__and__, [is_set(spot) for spot in _places(key, bits, probes)])
    return key.isNotNull() & hit
