"""Queries of the training-data operators over their whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat,
    contamination,
    fingerprints,
    language,
    line_dedup,
    ngram_join,
    packing,
    periodic,
    quality,
    substring,
    toxicity,
    variants,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_near_copies(table(spark, sf_dir, "documents"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    archives = warc.write_warc(table(spark, sf_dir, "pages"), folder)
    records = warc.read_warc(spark, folder, archives, payloads=False)
    return records.select(
        warc.id_from_record("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.id_from_record("refers_to").alias("refers_to"),
        "error",
    )


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", sha256(F.col("kept_text")).alias("kept_sha256")
    )


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def fifth(name: str) -> Column:
        return F.crc32(F.col(name).cast("string").cast("binary")) % 5

    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), fifth("_id") != 0)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        F.coalesce(fifth("doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    held_out = F.coalesce(third == 1, F.lit(False))
    model = language.fit_languages(docs, "text", "lang", F.col("doc_id"), third != 1)
    judged = language.identify_languages(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.drop_repeated_passages(docs).select(
        "doc_id", "n_words", "n_removed", sha256(F.col("kept_text")).alias("kept_sha256")
    )


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.sql(
        r"""SELECT * FROM VALUES
            (-7L, 0L, 'user', r'\### Assistant: </turn> ok'),
            (-7L, 1L, 'assistant', r'\### Assistant: </turn> ok') AS t(conv_id, turn, role, text)"""
    )
    done = chat.format_conversations(turns.unionByName(odd))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.loss_text(F.col("formatted"), F.col("turns"))
    return done.withColumn("_loss", loss).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        sha256(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        sha256(F.col("_loss")).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_leaks(docs, table(spark, sf_dir, "benchmark"), verbatim=True)
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("leaking"),
        F.array_distinct(F.transform("leaks", lambda x: x["item_id"])).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("leaks", lambda x: x["share"])), F.lit(0.0)).alias("share"),
    )


def edited_words(docs: DataFrame) -> DataFrame:
    """``word`` per run of Latin letters, lower-cased; one in 199, by hash, lacks a character."""
    # Shorter runs make no word of six characters.
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z\u00C0-\u00FF]{6,}"), 0)).alias("run"))
    lower = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    runs = runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), lower).otherwise(F.col("run")))
    number = F.crc32(F.encode(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")), "UTF-8"))
    runs = runs.withColumn("_h", number).withColumn("_at", (F.col("_h") % F.length("run")).cast("int"))
    shorter = F.concat(F.left("run", F.col("_at")), F.right("run", F.length("run") - F.col("_at") - 1))
    return runs.select(F.when(F.col("_h") % 199 == 0, shorter).otherwise(F.col("run")).alias("word"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.group_variants(edited_words(docs)).select("word", "form", "root", "n", "n_near", "form_n")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in a tenth of the documents, by hash, the words repeat from some place on."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.withColumn("_words", F.when(number % 10 == 0, words)).withColumn("_n", F.size("_words"))
    draw = F.floor(number / 10)
    # The draw picks the first repeated word and how often the stretch goes into the rest.
    chosen = chosen.withColumn("_a", F.when(F.col("_n") > 0, draw % F.col("_n")).cast("int"))
    period = F.floor((F.col("_n") - F.col("_a")) / (draw % 8 + 3)).cast("int") + 1
    chosen = chosen.withColumn("_p", period)
    tail = F.transform(
        F.sequence(F.col("_a"), F.col("_n") - 1),
        lambda i: F.get("_words", F.col("_a") + (i - F.col("_a")) % F.col("_p")),
    )
    edited = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), tail), " ")
    return chosen.select("doc_id", F.when(F.col("_n") > 0, edited).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    )
    found = found.withColumn("_best", longest.cast("struct<length:bigint,start:bigint,period:bigint>"))
    length, start, period = F.col("_best.length"), -F.col("_best.start"), -F.col("_best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("bigint").alias("exponent_milli"),
        sha256(lines).alias("runs_sha256"),
        sha256(F.col("collapsed_text")).alias("collapsed_sha256"),
    )


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def third(name: str) -> Column:
        return F.crc32(F.col(name).cast("string").cast("binary")) % 3

    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), third("_id") != 1)
    return quality.score_quality(docs, model).select(
        "doc_id",
        F.coalesce(third("doc_id") == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
