"""Overlapping chunks, the chunks nearest to given categories, and votes over chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Characters per chunk, and those it shares with the one before.
CHUNK_CHARS = 8000
OVERLAP_CHARS = 1600
TOP_CHUNKS = 5


def chunk_texts(
    documents: DataFrame, key: str, text: str = "text",
    size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """``key, chunk_no, start, chunk``: the whole text in overlapping pieces.

    A piece starts ``size - overlap`` characters after the one before; the last
    reaches the end of the text. An empty text is one empty piece, NULL has none.
    """
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - overlap) / F.lit(step)).cast("int") - 1, F.lit(0))
    pieces = documents.where(F.col(text).isNotNull()).select(
        key, F.col(text).alias("_text"), F.explode(F.sequence(F.lit(0), last)).alias("chunk_no")
    )
    start = F.col("chunk_no") * F.lit(step)
    return pieces.select(
        key, "chunk_no", start.alias("start"), F.substring("_text", start + 1, F.lit(size)).alias("chunk")
    )


def similarity(vector: Column, category: list[float]) -> Column:
    """Cosine of a vector and a given one; 0 where the vector has no length."""
    given = F.array(*[F.lit(float(x)) for x in category])
    size = sum(x * x for x in category) ** 0.5
    dot = F.aggregate(
        F.zip_with(vector, given, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x
    )
    square = F.aggregate(
        vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    return F.when(square > 0, dot / (F.sqrt(square) * F.lit(size))).otherwise(F.lit(0.0))


def top_chunks(
    vectors: DataFrame, document: str, chunk: str, vector: str,
    categories: dict[str, list[float]], k: int = TOP_CHUNKS,
) -> DataFrame:
    """``document, category, rank, chunk, score``: per document the k chunks nearest to each category.

    Every chunk is compared with the given short list of category vectors and
    with nothing else. Ranks cut each task's rows to k per document and category
    before they shuffle; equal scores go by the chunk's number.
    """
    scores = F.array(
        *[
            F.struct(F.lit(name).alias("category"), F.round(similarity(F.col(vector), given), 6).alias("score"))
            for name, given in categories.items()
        ]
    )
    scored = vectors.select(document, chunk, F.inline(scores))
    nearest = Window.partitionBy(document, "category").orderBy(F.desc("score"), chunk)
    ranked = scored.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select(document, "category", "rank", chunk, "score")


def vote(chunks: DataFrame, document: str, label: str, weight: str, least_share: float = 0.5) -> DataFrame:
    """``document, label, share, unclear``: the label with the greatest total weight.

    Equal totals go to the smaller label. ``unclear`` says that the label has no
    more than ``least_share`` of the document's weight.
    """
    totals = chunks.groupBy(document, label).agg(F.sum(weight).alias("_weight"))
    best = F.max(F.struct(F.col("_weight"), (-F.col(label)).alias("_label")))
    winners = totals.groupBy(document).agg(best.alias("_best"), F.sum("_weight").alias("_all"))
    share = F.round(F.col("_best._weight") / F.col("_all"), 6)
    return winners.select(
        document, (-F.col("_best._label")).alias(label), share.alias("share"),
        (share <= least_share).cast("int").alias("unclear"),
    )
