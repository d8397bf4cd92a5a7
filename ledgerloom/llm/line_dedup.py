"""Lines that many documents share are dropped everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import settle

# The characters stripped from a line's ends, and A-Z with a-z.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _digest(key: Column) -> Column:
    return F.unhex(F.md5(key.cast("binary")))


def drop_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text`` added.

    A line's key is the line stripped and with A-Z lower-cased. Keys of at
    least ``min_chars`` code points that occur in ``min_docs`` documents or more
    lose all their lines; the others stay in their order, joined by ``\\n``. A
    NULL or empty text is one empty line. Rows with equal ids are one document
    when documents are counted, NULL ids included, and each row loses its own
    lines. An input column named like an added one is replaced. No rows give no
    rows.

    Only 16-byte digests of the distinct lines of a document shuffle for the
    count, combined per task first; a line found in a third of all documents is
    one row per task there. Where the frequent digests meet the documents, the
    adaptive join splits such a line. Texts shuffle once, in the last join.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    keys = F.filter(
        F.transform(lines, line_key), lambda k: (k != "") & (F.length(k) >= min_chars)
    )
    pairs = docs.select(
        F.col(id_col).alias("_doc"),
        F.explode(F.array_distinct(F.transform(keys, _digest))).alias("_line"),
    )
    pairs = settle(pairs, "document-lines")
    frequent = (
        pairs.distinct().groupBy("_line").agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= min_docs)
        .select("_line")
    )
    # Settled, neither side comes in partitioned by line: a line that very many
    # documents share can be split below the join.
    frequent = settle(frequent, "frequent-lines")
    hits = pairs.join(frequent, "_line", "left_semi")
    per_doc = hits.groupBy("_doc").agg(F.collect_set("_line").alias("_frequent"))
    kept_names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    joined = docs.join(per_doc, docs[id_col].eqNullSafe(per_doc["_doc"]), "left")
    stays = F.filter(
        F.col("_lines"),
        lambda line: ~F.coalesce(
            F.array_contains(F.col("_frequent"), _digest(line_key(line))), F.lit(False)
        ),
    )
    kept = F.when(F.col("_frequent").isNull(), F.col("_lines")).otherwise(stays)
    return (
        joined.withColumn("_lines", lines)
        .withColumn("_kept", kept)
        .select(
            *kept_names,
            F.size("_lines").cast("bigint").alias("n_lines"),
            (F.size("_lines") - F.size("_kept")).cast("bigint").alias("n_dropped"),
            F.array_join("_kept", "\n").alias("kept_text"),
        )
    )
