"""Positions over all rows, in ranges that are counted before they are numbered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import settle


def running_total(df: DataFrame, order: str, amount: str | Column, into: str) -> DataFrame:
    """Adds the sum of ``amount`` over all rows ahead in ``order``.

    The rows are dealt to ranges of ``order`` and settled. Within a range a
    window sums up; what lies ahead of a range follows from one total per range,
    of which there are as many as shuffle partitions, whatever the rows. Rows
    alike in ``order`` are in one range, in no fixed order among each other.
    NULL comes first; no rows give no rows.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    ranged = df.withColumn("_amount", amount).repartitionByRange(order).withColumn("_range", F.spark_partition_id())
    ranged = settle(ranged, "ranges")
    totals = ranged.groupBy("_range").agg(F.sum("_amount").alias("total"))
    # One short array; a range's share is the sum of the entries ahead of its own.
    listed = totals.agg(F.array_sort(F.collect_list(F.struct("_range", "total"))).alias("_all"))
    ahead = listed.select(
        F.inline(
            F.transform(
                "_all",
                lambda own: F.struct(
                    own["_range"].alias("_own"),
                    F.aggregate(
                        F.filter("_all", lambda other: other["_range"] < own["_range"]),
                        F.lit(0).cast("bigint"),
                        lambda sum_, other: sum_ + F.coalesce(other["total"], F.lit(0)),
                    ).alias("_ahead"),
                ),
            )
        )
    )
    before = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("_amount").over(before), F.lit(0))
    placed = ranged.join(ahead, ranged["_range"] == ahead["_own"])
    return placed.withColumn(into, within + F.col("_ahead")).drop("_range", "_own", "_ahead", "_amount")
