"""Connected components of a graph of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import settle


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.hash("u", "v")).alias("s")
    ).first()
    return row.n, row.x, row.s


def connected_components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of the links ``u, v``: the smallest node it reaches.

    Alternates two steps until nothing changes: every node hangs its larger
    neighbours, then its smaller ones, to the smallest of them. Both are joins
    with one minimum per node, so a node with very many links is no single
    group; the number of rounds grows with the logarithm of the longest path.
    """
    edges = links.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = settle(edges.distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
        least = settle(least.select("_u", F.least("_u", "_m").alias("_m")), "least")
        large = both.join(least, both["u"] == least["_u"]).where(F.col("v") > F.col("u"))
        edges = large.select(F.col("v").alias("u"), F.col("_m").alias("v")).where(F.col("u") != F.col("v"))
        edges = settle(edges.distinct(), "large-star")
        least = settle(edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m")), "least")
        small = edges.join(least, edges["u"] == least["_u"]).select(F.col("v").alias("u"), F.col("_m").alias("v"))
        small = small.where(F.col("u") != F.col("v")).unionByName(
            least.select(F.col("_u").alias("u"), F.col("_m").alias("v"))
        )
        edges = settle(small.distinct(), "small-star")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
