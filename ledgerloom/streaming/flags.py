"""Opinion flags of report files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.text import decode_text
from ledgerloom.operators.reports import phrase_flags, slice_documents

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def document_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New text files in ``folder`` as ``document_name, text``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(folder)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.regexp_replace(name, r"\.[^.]+\z", "").alias("document_name"),
        decode_text(F.col("content")).alias("text"),
    )


def first_arrivals(flags: DataFrame) -> DataFrame:
    """Flags of the documents whose name no earlier batch of the stream has had.

    The state holds, per name, the flags and the batch they came with, and when
    the name was last seen. A batch looks up its own names and nothing else. Of
    several documents with one name in a batch the least flags stay.
    """
    rest = [c for c in flags.columns if c != "document_name"]
    # The time of a micro-batch is one for all its rows, and the same when it is replayed.
    arrived = flags.withColumn("_at", F.current_timestamp())
    seen = arrived.groupBy("document_name").agg(
        F.min(F.struct("_at", *rest)).alias("_first"), F.max("_at").alias("_last")
    )
    new = seen.where(F.col("_first._at") == F.col("_last"))
    return new.select("document_name", *[F.col(f"_first.{c}").alias(c) for c in rest])


def flag_stream(
    documents: DataFrame, out: str, checkpoint: str, patterns: dict[str, str] | None = None
) -> StreamingQuery:
    """Slice and flag every arriving document once, into the table folder ``out``.

    Which names are done is kept in a state store on the executors' disks and in
    ``checkpoint``, so a batch costs what arrives with it, however much came
    before. Flags shuffle to the state, texts do not; a document delivered again
    is flagged again and then left out. Each micro-batch owns the folder
    ``batch_id=<n>`` and overwrites it, so a batch that is replayed after a
    failure replaces its own rows.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    spark = documents.sparkSession
    flags = first_arrivals(phrase_flags(slice_documents(documents), patterns))
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:  # a query keeps the settings it starts with
        return (
            flags.writeStream.foreachBatch(write_batch)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def read_flags(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch_id")
