"""Entity master, key unions, panel counts, samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the type of ordinary shares.
ORDINARY_SHARES = "ORD SH"


def ordinary_shares(df: DataFrame) -> DataFrame:
    return df.where(F.col("stock_type") == ORDINARY_SHARES)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(frames: list[DataFrame], column: str) -> DataFrame:
    """Distinct values of one column over all frames; NULL once."""
    return union_all([f.select(column) for f in frames]).distinct()


def entity_master(sources: list[DataFrame]) -> DataFrame:
    """Ordinary shares of all sources: one row per code, ISIN and type.

    The greatest company name wins; a NULL ISIN is a group of its own. Repeated
    rows go first: that hashes, while a maximum of text has to sort what it reads.
    """
    columns = ["stock_code", "isin", "company", "stock_type"]
    rows = union_all([ordinary_shares(s).select(*columns) for s in sources]).distinct()
    return rows.groupBy("stock_code", "isin", "stock_type").agg(
        F.max("company").alias("company")
    ).select(*columns)


def yearly_panel(df: DataFrame, year: str, entity: str, flag: str) -> DataFrame:
    """Distinct firms, observations and the mean of a 0/1 flag for each year.

    Observations first fold to one row per year and firm, so a year that holds
    a third of the rows reaches its last task as firms, not observations.
    """
    per_firm = df.groupBy(year, entity).agg(
        F.count("*").alias("n"),
        F.count(flag).alias("flagged"),
        F.sum(F.col(flag).cast("bigint")).alias("total"),
    )
    return per_firm.groupBy(F.col(year).alias("year")).agg(
        F.count(entity).alias("firms"),
        F.sum("n").cast("bigint").alias("observations"),
        (F.sum("total") / F.sum("flagged")).alias("share"),
    )


def random_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows at random, all when there are fewer.

    The draw hashes seed and key, so a task that runs twice draws the same rows.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(draw, key).limit(n)


def preview(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
