"""Offer rows, board tables and the identifier master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cells import strip
from ledgerloom.operators.joins import left_lookup
from ledgerloom.operators.neighbours import WIDTH, running_last, with_neighbours


def merge_offer_rows(
    df: DataFrame,
    order: list[str],
    key: str = "stock_code",
    marker: str = "offer_location",
    amount: str = "funds_raised",
    segments: list[str] | None = None,
    width: int = WIDTH,
    mode: str = "above",
) -> DataFrame:
    """Move the amounts of (b)/(c) rows onto an earlier row of the same key.

    Rows come in the order of ``segments`` (the file, say) and then ``order``.
    With ``mode="above"`` the receiver is the row just above. It may itself be a
    (b) or (c) and go away, and its received amount with it. With
    ``mode="parent"`` the receiver is the last row above that is neither, so that
    no amount is lost; of several (b) or (c) rows of one parent the largest
    amount counts. A (b)/(c) row without a receiver stays, without an own amount.
    """
    if mode == "parent":
        return _merge_onto_parents(df, order, key, marker, amount, segments, width)
    if mode != "above":
        raise ValueError(f"no such mode: {mode}")
    place = F.coalesce(strip(F.col(marker)), F.lit(""))
    rows = df.withColumns({"_place": place, "_amount": F.col(amount)})
    near = with_neighbours(
        rows, [key], order, ["_place", "_amount"], 1, 1, segments, width
    )
    continues = F.col("_place").isin("(b)", "(c)")

    def received(mark: str):
        return F.when(F.col("next_1._place") == mark, F.col("next_1._amount"))

    return (
        near.where(~(continues & F.col("prev_1").isNotNull()))
        .withColumns(
            {
                "funds_raised_hk": F.when(~continues, F.col(amount)),
                "funds_raised_intl": received("(b)"),
                "funds_raised_sg": received("(c)"),
            }
        )
        .drop(amount, marker, "_place", "_amount", "prev_1", "next_1")
    )


def _merge_onto_parents(
    df: DataFrame, order: list[str], key: str, marker: str, amount: str, segments: list[str] | None, width: int
) -> DataFrame:
    place = F.coalesce(strip(F.col(marker)), F.lit(""))
    own = F.struct(*(segments or []), *order)
    parent = F.when(~place.isin("(b)", "(c)"), own)
    rows = running_last(df, [key], order, parent, "_parent", segments, width)
    # A parent and what continues it; the amounts combine before they shuffle.
    continues = place.isin("(b)", "(c)") & F.col("_parent").isNotNull()
    received = rows.where(continues).groupBy(F.col(key).alias("_key"), F.col("_parent").alias("_to")).agg(
        F.max(F.when(place == "(b)", F.col(amount))).alias("funds_raised_intl"),
        F.max(F.when(place == "(c)", F.col(amount))).alias("funds_raised_sg"),
    )
    stays = rows.where(~continues).withColumn("_own", own)
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_to"))
    hk = F.when(~place.isin("(b)", "(c)"), F.col(amount))
    joined = stays.join(received, same, "left")
    kept = [c for c in df.columns if c not in (amount, marker)]
    return joined.select(*kept, hk.alias("funds_raised_hk"), "funds_raised_intl", "funds_raised_sg")


def build_isin_master(agency: DataFrame, exchange: DataFrame, names: DataFrame) -> DataFrame:
    """Both identifier lists with the official short names.

    A stock code with several short names gives several rows.
    """
    both = agency.unionByName(exchange, allowMissingColumns=True)
    return left_lookup(both, names, [("stock_code", "stock_code")])
