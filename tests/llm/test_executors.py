"""Executors that cannot import the package: the classes have to come along."""

import os
import subprocess
import sys

import pytest

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from ledgerloom.session import build_session
from ledgerloom.llm.queries import QUERIES
from pyspark.sql import functions as F
spark = build_session("away", "local[2]", {{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}})
spark.sparkContext.setLogLevel("OFF")
def importable(batches):
    for batch in batches:
        try:
            import ledgerloom
            raise SystemExit("the package is there, so this test shows nothing")
        except ImportError:
            yield batch
importable.__module__ = "__main__"
spark.range(1).mapInArrow(importable, "id bigint").collect()
for name, query in QUERIES.items():
    query(spark, {FOLDER!r}).write.format("noop").mode("overwrite").save()
    print("ran", name)
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_every_query_runs_on_executors_without_the_package(tmp_path):
    from ledgerloom.llm.queries import QUERIES

    plain = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=900
    )
    ran = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert ran == list(QUERIES), done.stderr[-3000:]
