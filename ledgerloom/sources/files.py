"""CSV tables, sheets, id lists, report texts and file-name ids."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.functions.cells import strip
from ledgerloom.functions.names import id_from_name
from ledgerloom.functions.text import decode_text
from ledgerloom.operators.joins import semi_join
from ledgerloom.operators.positions import running_total
from ledgerloom.session import settle
from ledgerloom.sinks.files import FOLDER_CODES, NO_KEY, _mounted
from ledgerloom.sources.records import parse_records, read_records

LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _or_empty(spark: SparkSession, schema: StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


@contextmanager
def _few_listers(spark: SparkSession) -> Iterator[None]:
    """List folders by a few tasks a core; a task for each, up to ten thousand, costs more than its listing."""
    before = spark.conf.get(LISTERS)
    spark.conf.set(LISTERS, str(min(int(before), 16 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTERS, before)


def read_csv_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A CSV table under an explicit schema, its files with a header each.

    A missing file is an empty table. Cells in quotes may hold line ends; files
    are read in blocks all the same.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)

    def read() -> DataFrame:
        records = read_records(spark, path).where(F.col("record_no") > 0)
        return parse_records(records, schema.toDDL()).select("_row.*")

    return _or_empty(spark, schema, read)


def _in_file_order(df: DataFrame, position: str, kept: list[str]) -> DataFrame:
    """Number the rows of every file from 0 in file order.

    Row ids rise inside a file block, so a row's number is its distance from
    the block's first id plus the rows of the blocks before: one small
    aggregate by block instead of a sort of the file. Both reads of the files
    stay in one plan, as the ids hold for one way of splitting them only.
    """
    rows = df.select(
        *kept,
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    before = (
        Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        rows.groupBy("_path", "_block")
        .agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
        .select("_path", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        rows.join(blocks, ["_path", "_block"])
        .withColumn(position, F.col("_before") + F.col("_id") - F.col("_first"))
        .drop("_path", "_block", "_id", "_first", "_before")
    )


def _widest(rows: DataFrame, column: str) -> int:
    """Most cells of any row, quoted separators left out; an empty cell counts."""
    bare = F.regexp_replace(column, '"[^"]*+"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return (rows.agg(F.max(commas)).first()[0] or 0) + 1


def read_sheets(
    spark: SparkSession, glob: str, width: int | None = None, multi_line: bool = False
) -> DataFrame:
    """Sheets landed as header-less CSV to a grid with file name and row number.

    Every row has as many cells as the widest row of all the files, which is
    looked up first unless ``width`` is given. Empty cells are NULL. Blank sheet
    rows must be landed as separators only, since empty lines are passed over.
    Line breaks inside cells need ``multi_line``; then lines have to meet their
    records, at the price of a shuffle.
    """
    if multi_line:
        records = read_records(spark, glob)
        if width is None:  # read twice
            records = settle(records, "sheet-records")
            width = _widest(records, "record")
        columns = [f"c{i}" for i in range(width)]
        schema = ", ".join(f"{c} string" for c in columns)
        return parse_records(records, schema).select(
            "source_file", F.col("record_no").alias("row_idx"), F.array(*[f"_row.{c}" for c in columns]).alias("cells")
        )
    columns = [f"c{i}" for i in range(width or _widest(spark.read.text(glob), "value"))]
    schema = StructType([StructField(c, StringType()) for c in columns])
    raw = spark.read.schema(schema).options(quote='"', escape='"').csv(glob)
    grid = _in_file_order(raw, "row_idx", [F.array(*columns).alias("cells")])
    return grid.select("source_file", "row_idx", "cells")


def read_per_key(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The CSV files of ``sinks.files.write_per_key``; ``schema`` ends with the key."""
    with _few_listers(spark):
        return spark.read.schema(schema).options(header="true", quote='"', escape='"').csv(folder)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """``seq, id`` from text files: stripped, blank lines dropped; no file, no ids.

    ``seq`` counts the lines of all files, the files in the order of their names.
    """
    schema = StructType.fromDDL("source_file string, seq bigint, id string")

    def read() -> DataFrame:
        lines = _in_file_order(spark.read.text(path), "seq", [strip(F.col("value")).alias("id")])
        files = lines.groupBy("source_file").agg((F.max("seq") + 1).alias("_lines"))  # a row per file
        start = running_total(files, "source_file", "_lines", "_start").select("source_file", "_start")
        return lines.join(start, "source_file").withColumn("seq", F.col("seq") + F.col("_start"))

    return _or_empty(spark, schema, read).where(F.col("id") != "").select("seq", "id")


def read_documents(spark: SparkSession, glob: str) -> DataFrame:
    """``document_name, text`` per file, decoded as UTF-8 or else Latin-1."""
    files = spark.read.format("binaryFile").load(glob)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.regexp_replace(name, r"\.[^.]+\z", "").alias("document_name"),
        decode_text(F.col("content")).alias("text"),
    )


def _with_contents(listed: DataFrame, folder: str) -> DataFrame:
    """The listed documents with ``length`` and ``content`` of the files in their folders below ``folder``.

    Each task looks into the folders of its documents. Spark's reader would list all
    files on the driver first, and hold a folder, a file and a share of a task for
    each document. Like that reader, this passes over names with a leading underscore
    or dot, and gives a row per file, or one without a length. Contents of another
    length than listed are not read.
    """

    def read(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa

        columns = ["document_name", "bytes", "digest", "length", "content"]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def lost(error):
            if not isinstance(error, FileNotFoundError):
                raise error

        def files(name):
            if name in ("", NO_KEY):  # one folder, which stands for no name
                return
            own = f"{folder}/document_name={name.translate(FOLDER_CODES)}"
            for place, below, names in os.walk(own, onerror=lost):
                below[:] = [n for n in below if n[0] not in "_."]
                yield from (f"{place}/{n}" for n in names if n[0] not in "_.")

        def contents(name, size):
            there = False
            for path in files(name):
                there = True
                with open(path, "rb") as file:
                    length = os.fstat(file.fileno()).st_size
                    yield length, file.read() if length == size + 1 else None
            if not there:
                yield None, None

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], columns)

        rows, held = [], 0
        for batch in batches:
            for name, size, digest in zip(*(c.to_pylist() for c in batch.columns)):
                for length, content in contents(name, size):
                    rows.append((name, size, digest, length, content))
                    held += len(content or b"")
                    if held >= 1 << 23 or len(rows) == 10_000:
                        yield made(rows)
                        rows, held = [], 0
        if rows:
            yield made(rows)

    tasks = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = listed.select("document_name", "bytes", "digest").repartition(tasks, "document_name")
    return dealt.mapInArrow(read, "document_name string, bytes bigint, digest string, length bigint, content binary")


def read_written_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``document_name, text, error`` of the documents that ``sinks.files.write_documents`` lists.

    The text is decoded as UTF-8 or else Latin-1. ``error`` is NULL where the file
    holds what the list says; otherwise it says what is wrong, and the text is
    NULL. Files that are not on the list do not count. In a mounted file system
    nothing is listed on the driver; elsewhere it holds the list of all files.
    """
    base = folder.rstrip("/")
    listed = spark.read.parquet(f"{base}/list")
    plain = _mounted(spark, f"{base}/files")
    if plain and _exists(spark, f"{base}/files"):
        found = _with_contents(listed, plain)
    else:
        schema = "path string, modificationTime timestamp, length bigint, content binary, document_name string"
        with _few_listers(spark):
            files = spark.read.format("binaryFile").schema(schema).load(f"{base}/files")
        found = listed.join(files, "document_name", "left")
    body = F.substring("content", F.lit(1), F.col("bytes").cast("int"))
    whole = (F.col("length") == F.col("bytes") + 1) & (F.sha2("_body", 256) == F.col("digest"))
    wrong = F.when(F.col("length").isNull(), "not there").otherwise("not as it was written")
    return found.withColumn("_body", body).select(
        "document_name",
        F.when(whole, decode_text(F.col("_body"))).alias("text"),
        F.when(whole, None).otherwise(wrong).alias("error"),
    )


def ids_from_file_names(
    spark: SparkSession, glob: str, prefix: str = "press_releases_", suffix: str = ".csv"
) -> DataFrame:
    """Distinct ids named by landed files; contents are not read."""
    schema = StructType.fromDDL("path string")
    files = _or_empty(spark, schema, lambda: spark.read.format("binaryFile").load(glob))
    found = files.select(id_from_name(F.url_decode("path"), prefix, suffix).alias("id"))
    return found.where(F.col("id").isNotNull()).distinct()


def fundamentals(df: DataFrame, filters: dict[str, object], columns: list[str] | None) -> DataFrame:
    """Rows equal on every filter column, projected; ``None`` keeps all columns."""
    for name, value in filters.items():
        df = df.where(F.col(name) == F.lit(value))
    return df if columns is None else df.select(*columns)


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: str | Column) -> DataFrame:
    """The rows whose key is on the list."""
    return semi_join(df, keys, on)
