"""The corpus pipeline: from documents to packed training bins, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import contamination, language, line_dedup, ngram_join, packing
from ledgerloom.session import settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; texts without a letter go."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = language.fit_languages(docs, "text", "lang", F.col("doc_id"), third != 1)
    judged = language.identify_languages(docs, model, into="_lang_pred", score_into="_lang_score")
    if model is None:
        return judged.where(F.col("text").rlike(r"\p{L}")).select(*docs.columns)
    return judged.where(F.col("_lang_pred") != language.UNKNOWN).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more share."""
    kept = line_dedup.drop_common_lines(docs)
    text = F.col("kept_text")
    columns = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return kept.withColumns(columns).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, once.

    Documents without an id stay: none of them can be named as the one to keep.
    """
    linked = ngram_join.link_near_copies(docs)
    gone = linked.where(F.col("component_id") != F.col("doc_id")).select(
        F.col("doc_id").alias("_gone")
    ).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text"))
    named = left.where(F.col("doc_id").isNotNull()).withColumn("_first", first)
    nameless = left.where(F.col("doc_id").isNull()).withColumn("_first", F.lit(1))
    return named.unionByName(nameless).where(F.col("_first") == 1).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other slot values."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.drop_leaking(docs, benchmark, verbatim=True)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the bins they go to."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack_bins),
]

# The first stage is a learned classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
