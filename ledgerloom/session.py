"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE is what splits a hot join key at run time, so it is always on; the forced
# form also splits when the split costs one more shuffle further up the plan.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes; wide projections (a dozen
    # cleaned columns) run faster as separate smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "ledgerloom",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_LOCAL_SCRATCH: dict[str, str] = {}
# Folders handed out, for each open `scratch_scope`, the innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the session's ``spark.checkpoint.dir``.

    On a cluster the folder has to be shared, so an unset value is an error
    there; only a local master gets a temporary folder, one per application.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = context.applicationId
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="ledgerloom-")
        base = _LOCAL_SCRATCH[app]
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the scratch folders that were made inside.

    Results read from them have to be written or collected by then::

        with scratch_scope(spark):
            classified_firm_quarters(...).write.parquet(target)
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a summary that several steps share and read it back.

    The lineage ends there, and the planner knows the true size: a join with it
    is a broadcast below ``spark.sql.autoBroadcastJoinThreshold`` and a shuffle
    above, while for an aggregate it would have to guess.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
