"""Batches of texts small enough for a Python worker."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Rows per Arrow batch. Texts of a few thousand characters make batches of a few
# megabytes, of which the JVM and the worker hold several at a time.
BATCH_ROWS = 1000
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to `BATCH_ROWS` rows; smaller ones stay."""
    given = int(spark.conf.get(SETTING, "10000"))
    if given <= 0 or given > BATCH_ROWS:
        spark.conf.set(SETTING, str(BATCH_ROWS))
