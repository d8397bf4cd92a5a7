"""The nearest vectors of a table of query vectors, by cells that cannot hold them left out.

Vectors are brought to length one, where cosine and distance say the same, and
assigned to the nearest of some centres. By the triangle inequality a vector at
distance r from its centre is at least |D - r| from a query at distance D from that
centre. So once k vectors are known to be within t of a query, only vectors with
|D - r| <= t need to be compared, and the result is that of comparing all.

Vectors of like cell and r form blocks of about ``BLOCK_ROWS``. A block that the bound
leaves open is multiplied with its queries as a matrix, and gives k rows for each.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import settle

# Centres, and the vectors they are fitted on, about.
CELLS = 32
SAMPLE_ROWS = 20_000
# Digits of a score; equal scores go by id.
DIGITS = 6
# What rounding may hide of a squared distance, and of a distance.
SLACK = 4.0 * 10.0**-DIGITS
TINY = 1e-9
# Vectors of a block, queries that meet it at once, and scores held at once.
BLOCK_ROWS = 8_192
QUERY_ROWS = 16_384
SCORES = 1 << 22


def _dot(one: Column, other: Column) -> Column:
    return F.aggregate(F.zip_with(one, other, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def _distance(one: Column, other: Column) -> Column:
    square = F.aggregate(
        F.zip_with(one, other, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
    )
    return F.sqrt(square)


def _unit(vector: str, asks: bool) -> Column:
    """A vector of length one; one without length is at right angles to all of the other side."""
    plain = F.transform(vector, lambda x: x.cast("double"))
    none = F.transform(plain, lambda x: F.lit(0.0))
    size = F.sqrt(_dot(plain, plain))
    ends = F.array(F.lit(float(not asks)), F.lit(float(asks)))
    # The length is worked out once, not for every entry.
    scaled = F.get(
        F.transform(F.array(size), lambda s: F.transform(plain, lambda x: x / s)), F.lit(0)
    )
    return F.when(size > 0, F.concat(scaled, F.array(F.lit(0.0), F.lit(0.0)))).otherwise(F.concat(none, ends))


def fit_centres(points: DataFrame, cells: int = CELLS, rows: int = SAMPLE_ROWS) -> list[list[float]]:
    """Centres of ``_unit`` vectors, fitted on about ``rows`` of them by the hash of ``_id``.

    The centres steer what is compared, never the result.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    count = points.count()
    share = min(rows / max(count, 1), 1.0)
    sample = points.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    sample = settle(sample.select("_unit").distinct(), "centre-sample")
    different = sample.count()
    if different < 2:
        only = sample.first()
        return [only._unit if only else []]
    features = sample.select(array_to_vector("_unit").alias("features"))
    fitted = KMeans(k=min(cells, different), seed=5, maxIter=8).fit(features)
    return [[float(x) for x in centre] for centre in fitted.clusterCenters()]


def _centre_table(centres: list[list[float]]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("cell"), F.array(*[F.lit(x) for x in centre]).cast("array<double>").alias("centre")
            )
            for i, centre in enumerate(centres)
        ]
    )


def _best_of_block(k: int) -> Callable:
    """A block of vectors and queries open to it: ``_query, _id, _dot`` of the k best for each query.

    They are picked by rounded score and then id, as in the end. What is given is
    added up in the order of the entries, so that equal vectors score the same anywhere.
    """

    def matrix(column):
        import pyarrow as pa

        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def best(asked, held):
        import numpy as np
        import pyarrow as pa

        if not asked.num_rows or not held.num_rows:
            return pa.table({"_query": asked["_query"][:0], "_id": held["_id"][:0], "_dot": pa.array([], "float64")})
        held = held.sort_by("_id")
        points, queries = matrix(held["_unit"]), matrix(asked["_asked"])
        count = len(points)
        kept = min(k, count)
        place = np.arange(count, dtype=np.float64)
        froms, tos, dots = [], [], []
        step = max(SCORES // count, 1)
        for at in range(0, len(queries), step):
            some = queries[at : at + step]
            # Score and place in one number, all of them different.
            order = some @ points.T
            order *= -(10.0**DIGITS)
            np.rint(order, out=order)
            order *= count
            order += place
            to = np.argpartition(order, kept - 1, axis=1)[:, :kept].ravel()
            own = np.repeat(np.arange(len(some)), kept)
            dots.append(np.cumsum(some[own] * points[to], axis=1)[:, -1])
            froms.append(own + at)
            tos.append(to)
        return pa.table({
            "_query": asked["_query"].take(pa.array(np.concatenate(froms))),
            "_id": held["_id"].take(pa.array(np.concatenate(tos))),
            "_dot": pa.array(np.concatenate(dots)),
        })

    return best


def _compare(ways: DataFrame, asked: DataFrame, blocks: DataFrame, parts: int, k: int) -> DataFrame:
    """``_query, _id, _dot`` of the k best of each block for each query of ``ways`` (``_query, block``).

    Queries meet a block in ``parts``, which bounds what a task holds.
    """
    part = F.pmod(F.xxhash64("_query"), F.lit(parts)).alias("_part")
    left = ways.select("_query", "block").join(asked, "_query").select("block", part, "_query", "_asked")
    ends = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("_part")
    right = blocks.select("block", ends, "_id", "_unit")
    types = {f.name: f.dataType.simpleString() for f in (*asked.schema, *blocks.schema)}
    return left.groupBy("block", "_part").cogroup(right.groupBy("block", "_part")).applyInArrow(
        _best_of_block(k), f"_query {types['_query']}, _id {types['_id']}, _dot double"
    )


def nearest_vectors(
    vectors: DataFrame, queries: DataFrame, k: int,
    id_col: str = "vec_id", vector_col: str = "embedding",
    query_id: str = "query_id", query_vector: str = "embedding", cells: int = CELLS,
) -> tuple[DataFrame, DataFrame]:
    """``query_id, rank, id, score`` of the k vectors nearest to each query, and what it took.


    The score is the cosine, rounded to ``DIGITS``; equal scores go by id; a
    vector without length scores 0. NULL vectors and NULL ids take no part. Ids
    are unique on each side. The second frame is one row, ``compared``: how many
    pairs of a query and a vector were compared in the end.
    """
    points = settle(
        vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("_id"), _unit(vector_col, False).alias("_unit")),
        "unit-vectors",
    )
    asked = queries.where(F.col(query_vector).isNotNull() & F.col(query_id).isNotNull()).select(
        F.col(query_id).alias("_query"), _unit(query_vector, True).alias("_asked")
    )
    asked = settle(asked, "unit-queries")
    table = _centre_table(fit_centres(points, cells))
    # Nearest centre of each vector, and how far it is.
    distances = F.transform(table, lambda c: F.struct(_distance(F.col("_unit"), c["centre"]).alias("r"), c["cell"].alias("cell")))
    placed = settle(points.select("_id", "_unit", F.array_min(distances).alias("_n")).select("_id", "_unit", "_n.r", "_n.cell"), "vector-cells")
    # Blocks of like distance from one centre. Ids are in the order, so that equal vectors part too.
    ranges = math.ceil(placed.count() / BLOCK_ROWS) or 1
    dealt = placed.repartitionByRange(ranges, "cell", "r", "_id")
    block = F.spark_partition_id().cast("bigint") * F.lit(cells) + F.col("cell")
    blocks = settle(dealt.withColumn("block", block), "vector-blocks")
    sizes = settle(
        blocks.groupBy("block", "cell").agg(F.count("*").alias("_size"), F.max("r").alias("_reach"), F.min("r").alias("_core")),
        "block-sizes",
    )
    ways = asked.select("_query", "_asked", F.inline(table)).select(
        "_query", "cell", _distance(F.col("_asked"), F.col("centre")).alias("d")
    )
    ways = settle(ways.join(sizes, "cell"), "query-blocks")  # a row per query and block
    # The nearest blocks that hold k vectors between them bound the distance of the k-th.
    gap = F.greatest(F.col("d") - F.col("_reach"), F.col("_core") - F.col("d"), F.lit(0.0))
    earlier = Window.partitionBy("_query").orderBy("d", "cell", gap, "block").rowsBetween(Window.unboundedPreceding, -1)
    first = ways.withColumn("_held", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).where(F.col("_held") < k)
    parts = math.ceil(asked.count() / QUERY_ROWS) or 1
    near = _compare(first, asked, blocks, parts, k)
    rank = F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("_dot")))
    bound = near.withColumn("_rank", rank).where(F.col("_rank") <= k).groupBy("_query").agg(F.min("_dot").alias("_dot"))
    far = F.sqrt(F.greatest(2 - 2 * F.col("_dot"), F.lit(0.0)) + SLACK) + TINY  # of two unit vectors
    bound = settle(bound.select(F.col("_query").alias("_bound_of"), far.alias("_within")), "query-bounds")
    open_ways = ways.join(bound, ways["_query"] == bound["_bound_of"]).where(
        (F.col("d") - F.col("_reach") <= F.col("_within")) & (F.col("_core") - F.col("d") <= F.col("_within"))
    )
    compared = _compare(open_ways, asked, blocks, parts, k).select(
        "_query", "_id", F.round("_dot", DIGITS).alias("score")
    )
    best = F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("score"), "_id"))
    found = compared.withColumn("rank", best).where(F.col("rank") <= k)
    found = found.select(F.col("_query").alias(query_id), "rank", F.col("_id").alias(id_col), "score")
    return found, open_ways.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("compared"))
