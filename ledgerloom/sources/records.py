"""Records of quoted, delimited text, read in blocks by many tasks.

A cell in quotes may hold line ends, so a line need not be a record, and whether a
line starts inside quotes depends on all the lines before it. What a line does to
that is small: for either start it says whether its end is inside quotes. These
effects are joined up within a block of the file, then over the blocks, of which
there are few; after that every line knows its record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD = "source_file string, record_no bigint, record string"


def _effects(line: Column, separator: str) -> tuple[Column, Column]:
    """Whether the end of a line is inside quotes, if its start is outside, and inside.

    Quotes count where a cell starts; inside quotes, doubled ones stand for one
    and the next single one ends them. Other quotes are text.
    """
    sep = "\\Q" + separator + "\\E"

    def open_at_end(text: Column) -> Column:
        closed = F.regexp_replace(text, f'(^|{sep})"[^"]*+"', "$1")
        return closed.rlike(f'(?:^|{sep})"')

    single = F.replace(line, F.lit('""'), F.lit(""))
    # Behind the quote that ends the cell of an earlier line, no cell starts.
    behind = F.regexp_replace(single, '^[^"]*+"', ".")
    return (
        F.when(F.contains(single, F.lit('"')), open_at_end(single)).otherwise(F.lit(False)),
        F.when(F.contains(single, F.lit('"')), open_at_end(behind)).otherwise(F.lit(True)),
    )


def _joined(df: DataFrame, group: list[str], order: str) -> DataFrame:
    """Adds what comes before each row: ``inside`` if the group starts outside, and ``open``,
    whether a start inside would turn that round.

    Rows have their effects as ``_out`` and ``_in``: both alike (whatever was before
    is forgotten), or in turn, or keeping what was.
    """
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum(F.when(F.col("_out") & ~F.col("_in"), 1).otherwise(0)).over(upto)
    turned = df.withColumn("_turns", turns)
    forgets = F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").alias("state"), F.col("_turns").alias("turns")))
    last = F.last(forgets, ignorenulls=True).over(before)
    ahead = F.coalesce(F.lag("_turns").over(Window.partitionBy(*group).orderBy(order)), F.lit(0))
    placed = turned.withColumns({"_last": last, "_ahead": ahead})
    odd = (F.col("_ahead") - F.coalesce(F.col("_last.turns"), F.lit(0))) % 2 == 1
    state = F.coalesce(F.col("_last.state"), F.lit(False))
    return placed.withColumns({"inside": state != odd, "open": F.col("_last").isNull()}).drop("_turns", "_last", "_ahead")


def read_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """``source_file, record_no, record``: the records of every file, numbered from 0.

    A record ends at a line end outside quotes, which is not part of it, nor is a
    carriage return ahead of it. Empty lines outside quotes are no records. A quote
    that nothing ends takes in the rest of its file. Files are read in blocks; the
    lines of a block are in one task, and so are those of a record of several lines.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    bare = F.regexp_replace("value", "\r$", "")
    outside, inside = _effects(bare, separator)
    lines = _joined(lines.withColumns({"_out": outside, "_in": inside}), ["_path", "_block"], "_id")
    empty = F.col("value").isin("", "\r")

    def starts(inside: Column) -> Column:
        return ~inside & ~empty

    # Of each block: its own effect, and how many records start in it either way.
    other = F.col("inside") != F.col("open")  # if the block starts inside
    last = F.max_by(F.struct("inside", "open", "_out", "_in"), "_id")
    blocks = lines.groupBy("_path", "_block").agg(
        last.alias("_end"),
        F.count_if(starts(F.col("inside"))).alias("_n_out"),
        F.count_if(starts(other)).alias("_n_in"),
    )

    def after(inside: Column) -> Column:
        return F.when(inside, F.col("_end._in")).otherwise(F.col("_end._out"))

    blocks = blocks.withColumns(
        {"_out": after(F.col("_end.inside")), "_in": after(F.col("_end.inside") != F.col("_end.open"))}
    )
    blocks = _joined(blocks, ["_path"], "_block")
    count = F.when(F.col("inside"), F.col("_n_in")).otherwise(F.col("_n_out"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("_path").alias("_p"), F.col("_block").alias("_b"), F.col("inside").alias("_begins_inside"),
        F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias("_earlier"),
    )
    lines = lines.join(blocks, (F.col("_path") == F.col("_p")) & (F.col("_block") == F.col("_b")))
    lines = lines.withColumn("_inside", F.col("inside") != (F.col("open") & F.col("_begins_inside")))
    lines = lines.where(F.col("_inside") | ~empty)
    upto = Window.partitionBy("_path", "_block").orderBy("_id")
    number = F.col("_earlier") + F.sum(F.when(F.col("_inside"), 0).otherwise(1)).over(upto) - 1
    follows = F.lead("_inside").over(upto)
    lines = lines.withColumns({"record_no": number, "_alone": ~F.col("_inside") & ~follows})
    whole = F.coalesce("_alone", F.lit(False))
    alone = lines.where(whole).select("source_file", "record_no", F.col("value").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_id", "value")))
    joined = lines.where(~whole).groupBy("_path", "record_no").agg(
        F.first("source_file").alias("source_file"), F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("record")
    )
    every = alone.unionByName(joined.select("source_file", "record_no", "record"))
    return every.withColumn("record", F.regexp_replace("record", "\r$", ""))


def parse_records(records: DataFrame, schema: str, separator: str = ",") -> DataFrame:
    """Records as columns ``_row.*`` of a schema, ahead of the other columns."""
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    return records.withColumn("_row", F.from_csv("record", schema, options)).drop("record")
