"""Report texts to opinion flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions.cells import strip
from ledgerloom.functions.names import name_date, stem
from ledgerloom.operators.joins import keep_listed, spread_join
from ledgerloom.operators.sketches import key_filter, may_be_key
from ledgerloom.operators.worklist import skip_done
from ledgerloom.session import settle


def section_documents(
    documents: DataFrame, start=T.START_KEYWORDS, stop=T.STOP_KEYWORDS, min_chars: int = T.MIN_CHARS
) -> DataFrame:
    """Every text cut to its section under the first heading.

    The section ends at the next stop line or line in capitals; a shorter one
    runs on to the end of the line where ``min_chars`` is reached, or to the
    end of the text. Without a start line the text stays, less table lines.
    """
    steps = (
        documents.withColumn("_cleaned", T.remove_table_lines(F.col("text")))
        .withColumn("_tail", T.from_first_start(F.col("_cleaned"), start))
        .withColumn("_section", T.to_section_end(F.col("_tail"), start, stop))
    )
    section = (
        F.when(F.col("_tail") == "", F.col("_cleaned"))
        .when(F.length("_section") >= min_chars, strip(F.col("_section")))
        .when(F.length("_tail") >= min_chars, strip(T.leading_lines(F.col("_tail"), min_chars)))
        .otherwise(strip(F.col("_tail")))
    )
    return steps.withColumn("text", section).drop("_cleaned", "_tail", "_section")


def slice_documents(
    documents: DataFrame, start=T.START_KEYWORDS, stop=T.STOP_KEYWORDS, min_chars: int = T.MIN_CHARS
) -> DataFrame:
    """Every text as ASCII without its stop blocks, tidied.

    Nothing survives the blocks only when no start line exists; the section
    search would then return the text without table lines, so that is used.
    """
    kept = T.remove_stop_blocks(F.col("_ascii"), start, stop, min_chars)
    fallback = T.remove_table_lines(F.col("_ascii"))
    return (
        documents.withColumn("_ascii", T.remove_non_ascii(F.col("text")))
        .withColumn("_kept", kept)
        .withColumn("_kept", F.when(F.col("_kept") == "", fallback).otherwise(F.col("_kept")))
        .withColumn("text", T.tidy_lines(F.col("_kept")))
        .drop("_ascii", "_kept")
    )


def phrase_flags(documents: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """``document_name, report_date`` and one 0/1 column per pattern; empty texts go.

    Empty texts go by way of ``explode``: a filter would be pushed below the
    slicing that made the text and run it a second time.
    """
    some = F.explode(F.filter(F.array("text"), lambda t: t != "")).alias("_text")
    folded = documents.select("document_name", some).withColumn(
        "_folded", T.fold_text(F.col("_text"))
    )
    return folded.select(
        "document_name",
        name_date(F.col("document_name")).alias("report_date"),
        *[
            T.phrase_flag(F.col("_folded"), pattern).alias(name)
            for name, pattern in (patterns or T.OPINION_PATTERNS).items()
        ],
    )


def texts_for_paths(paths: DataFrame, documents: DataFrame, path: str = "pdf_path") -> DataFrame:
    """Text of each listed path by file stem; a missing or empty text gives no row.

    The list is settled, so the planner sends a short one to the texts. Against a
    long one the texts have to move; those that a filter of all listed names
    rules out go in the task that reads them.
    """
    wanted = settle(paths.select(stem(F.col(path)).alias("document_name")), "wanted")
    listed = settle(key_filter(wanted, "document_name"), "wanted-filter")
    texts = documents.where(F.length("text") > 0).select(
        stem(F.col("document_name")).alias("document_name"), "text"
    ).where(may_be_key(listed, F.col("document_name")))
    return spread_join(texts, wanted.select(F.col("document_name").alias("_wanted")), [("document_name", "_wanted")], "inner")


def flag_paths(
    paths: DataFrame, documents: DataFrame, patterns: dict[str, str] | None = None,
    path: str = "pdf_path",
) -> DataFrame:
    """Flags of the sliced text behind each listed path, one row per path.

    Texts nobody asked for go before anything is sliced, so that the work
    follows the list and not the corpus.
    """
    wanted = settle(paths.select(stem(F.col(path)).alias("document_name")), "wanted")
    named = documents.withColumn("document_name", stem(F.col("document_name")))
    asked = keep_listed(named, wanted, [("document_name", "document_name")])
    flags = phrase_flags(slice_documents(asked), patterns)
    return wanted.join(flags, "document_name", "inner")


def flag_new_documents(
    documents: DataFrame, done: DataFrame, patterns: dict[str, str] | None = None
) -> DataFrame:
    """Flags of the documents that the earlier output ``done`` does not hold."""
    return phrase_flags(skip_done(documents, done), patterns)
