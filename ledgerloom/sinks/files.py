"""Tables, views, exports and key lists.

Every writer replaces its own target, so a run that is repeated after a failure
leaves the same files; tables and exports are whole at any time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.neighbours import big_groups, with_group_rows

# Rows per output file, so that one hot key does not make one endless file.
MAX_FILE_ROWS = 5_000_000

# What Spark's writers put for a character in the name of a key's folder, and for no key.
FOLDER_CODES = {i: f"%{i:02X}" for i in (*range(1, 32), 127, *b"\"#%'*/:=?\\{[]^")}
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def _swap_in(spark: SparkSession, fresh: str, target: str) -> None:
    """Put the folder ``fresh`` in the place of ``target``, by renames only.

    Between the two renames there is no target for a moment; should the second
    fail, the old one comes back.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    new, place, old = hadoop(fresh), hadoop(target), hadoop(f"{fresh}-old")
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"cannot move {target} out of the way")
    if not files.rename(new, place):
        if had:
            files.rename(old, place)
        raise OSError(f"cannot move the new table to {target}")
    if had:
        files.delete(old, True)


def _replace_folder(writer: DataFrameWriter, spark: SparkSession, target: str) -> None:
    """Write beside ``target`` and swap; a failed write leaves ``target`` as it was."""
    _replace_with(lambda fresh: writer.mode("errorifexists").save(fresh), spark, target)


def _replace_with(write: Callable[[str], None], spark: SparkSession, target: str) -> None:
    target = target.rstrip("/")
    parent, _, name = target.rpartition("/")
    # Spark's readers pass over names with a leading underscore.
    fresh = f"{parent}/_{name}-{uuid.uuid4().hex}"
    try:
        write(fresh)
    except BaseException:
        path = spark._jvm.org.apache.hadoop.fs.Path(fresh)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        raise
    _swap_in(spark, fresh, target)


def replace_table(
    df: DataFrame, target: str, fmt: str = "parquet", skip_empty: bool = False
) -> int:
    """Write ``df`` over the path or table ``target``; returns the rows written.

    The new table is written beside the old one and takes its place when it is
    whole, so a job that fails midway leaves the old table readable, and a table
    can be replaced by a query on itself. With ``skip_empty`` an empty result
    leaves the target as it was.
    """
    if skip_empty and df.isEmpty():
        return 0
    spark = df.sparkSession
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt)
    if "/" in target:
        _replace_folder(writer, spark, target)
    else:
        fresh = f"{target}_{uuid.uuid4().hex}"
        try:
            writer.saveAsTable(fresh)
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {fresh}")
            raise
        spark.sql(f"DROP TABLE IF EXISTS {target}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {target}")
    return seen.get["rows"]


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def export_name(query: str, position: int = 1, total: int = 1) -> str:
    """File name of a query's export; several statements get a number."""
    base = query.removeprefix("select_")
    return base if total == 1 else f"{base}_query_{position}"


def export_queries(
    queries: dict[str, DataFrame | list[DataFrame]], folder: str, fmt: str = "csv"
) -> list[str]:
    """One export per query (or per statement of it); returns the folders written."""
    written = []
    for query, frames in queries.items():
        frames = frames if isinstance(frames, list) else [frames]
        for i, df in enumerate(frames, start=1):
            target = f"{folder.rstrip('/')}/{export_name(query, i, len(frames))}"
            writer = df.write.format(fmt)
            if fmt == "csv":
                writer = writer.options(header="true", quote='"', escape='"')
            _replace_folder(writer, df.sparkSession, target)
            written.append(target)
    return written


def sorted_keys(df: DataFrame, distinct: bool = True) -> DataFrame:
    """The single column of ``df`` in ascending order.

    Distinct lists drop NULL; the others also drop 0 and '' and keep repeats.
    """
    if len(df.columns) != 1:
        raise ValueError("a key list needs a query with one column")
    name = df.columns[0]
    keys = df.na.drop()
    if distinct:
        return keys.distinct().orderBy(name)
    # Equal keys fall into one sort range; the reading task as a second key lets a
    # hot one span several, and is the same when a task has to run again.
    repeated = keys.where(~F.col(name).cast("string").isin("", "0"))
    return (
        repeated.withColumn("_task", F.spark_partition_id()).orderBy(name, "_task").drop("_task")
    )


def export_keys(df: DataFrame, target: str, distinct: bool = True) -> None:
    """One key per line, sorted by value; the part files follow the order."""
    keys = sorted_keys(df, distinct)
    keys.select(F.col(keys.columns[0]).cast("string").alias("value")).write.mode(
        "overwrite"
    ).text(target)


def _mounted(spark: SparkSession, folder: str) -> str | None:
    """The plain path of a folder in a mounted file system; None in any other store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return whole.getPath() if whole.getScheme() == "file" else None


def _write_bodies(rows: DataFrame, key: str, folder: str, ending: str, head: bytes, most: int) -> None:
    """The binary ``_body`` of every row as a line in a file of its task and key, below ``folder``.

    Without Hadoop's native library Spark's writers start three processes for every
    file in a mounted file system, to set modes; this writes the file and no more. A
    file gets its name when it is whole, so tasks may run twice. ``most`` is the
    number of lines a file may have.
    """
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"file:{folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)

    def write(batches: Iterator) -> Iterator:
        import os
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        now, file, lines, count = None, None, 0, 0

        def close():
            if file:
                file.close()
                os.replace(file.name, f"{os.path.dirname(file.name)}/part-{task:05d}-{count:05d}.{ending}")

        for batch in batches:
            for name, body in zip(*batch.columns):
                name = name.as_py() or ""  # both go to one folder
                if file is None or name != now or lines == most:
                    close()
                    count, lines = (count + 1 if file and name == now else 0), 0
                    now, value = name, name.translate(FOLDER_CODES) or NO_KEY
                    os.makedirs(own := f"{folder}/{key}={value}", exist_ok=True)
                    file = open(f"{own}/_{attempt}", "wb")
                    file.write(head)
                file.write(body.as_py() + b"\n")
                lines += 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["none"])

    named = rows.select(F.col(key).cast("string").alias(key), "_body").sortWithinPartitions(key)
    named.mapInArrow(write, "none bigint").write.format("noop").mode("overwrite").save()


def write_per_key(df: DataFrame, target: str, key: str = "stock_id", fmt: str = "csv") -> None:
    """A folder per key, each key in one task so that it has few files.

    Keys with more than ``MAX_FILE_ROWS`` rows go to as many tasks as they need
    files, by row and reading task, so that copies of a row part as well. The
    task count is fixed, as many small folders are work, not data.
    """
    big = big_groups(df, [key], MAX_FILE_ROWS)
    part = F.lit(0).cast("bigint")
    if big is not None:
        files = F.ceil(F.col("_rows") / F.lit(MAX_FILE_ROWS))
        spread = F.xxhash64(*df.columns, F.spark_partition_id())
        part = F.coalesce(F.pmod(spread, files), part)
        df = with_group_rows(df, [key], big)
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_part", part).repartition(tasks, key, "_part").drop("_part", "_rows")
    most = 2 * MAX_FILE_ROWS
    cells = {"quote": '"', "escape": '"'}
    others = [c for c in dealt.columns if c != key]
    if fmt == "csv" and others and _mounted(spark, target):
        names = F.to_csv(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(others)]), cells)
        head = spark.range(1).select(F.encode(names, "UTF-8").alias("head")).first().head
        lines = dealt.select(key, F.encode(F.to_csv(F.struct(*others), cells), "UTF-8").alias("_body"))
        _replace_with(
            lambda fresh: _write_bodies(lines, key, _mounted(spark, fresh), "csv", bytes(head) + b"\n", most), spark, target
        )
        return
    (
        dealt.write.mode("overwrite")
        .options(header="true", maxRecordsPerFile=str(most), **cells)
        .partitionBy(key)
        .format(fmt)
        .save(target)
    )


def write_documents(
    df: DataFrame, folder: str, name: str = "document_name", text: str = "text", encoding: str = "UTF-8"
) -> int:
    """One file per row in ``folder/files``, and the list of those that count in ``folder/list``.

    A document's file lies in a folder of its name and holds its text and one line
    end; NULL is the empty text. The list has the name, bytes and SHA-256 of each.
    Both replace what was there when they are whole. A missing name, a name that
    two rows have and a character that ``encoding`` lacks fail the job. Returns the
    number of documents. For millions of documents a table serves better.
    """
    spark = df.sparkSession
    named = F.coalesce(F.col(name).cast("string"), F.raise_error(F.lit("a document without a name")))
    bodies = df.select(
        named.alias("document_name"), F.encode(F.coalesce(text, F.lit("")), encoding).alias("_body")
    )
    once = F.when(F.count("*") == 1, F.max(F.length("_body"))).otherwise(
        F.raise_error(F.concat(F.lit("two documents named "), F.col("document_name"))).cast("int")
    )
    listed = bodies.groupBy("document_name").agg(
        once.cast("bigint").alias("bytes"), F.max(F.sha2("_body", 256)).alias("digest")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = bodies.repartition(tasks, "document_name")
    target = folder.rstrip("/")
    count = replace_table(listed, f"{target}/list")

    def write(fresh: str) -> None:
        if plain := _mounted(spark, fresh):
            return _write_bodies(dealt, "document_name", plain, "txt", b"", 1)
        # The bytes go through as they are, whatever the encoding.
        lines = dealt.select("document_name", F.col("_body").cast("string").alias("value"))
        lines.write.partitionBy("document_name").text(fresh)

    _replace_with(write, spark, f"{target}/files")
    return count
