"""Files in and out, and the stream against the batch."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import shapes as S
from ledgerloom.catalog.queries import QUERIES
from ledgerloom.operators.reports import phrase_flags, slice_documents
from ledgerloom.session import scratch_path, settle
from ledgerloom.sinks import files as sinks
from ledgerloom.sources import files as sources
from ledgerloom.streaming import flags as stream


def lines(folder):
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    return [line for p in parts for line in open(f"{folder}/{p}", encoding="utf-8").read().splitlines()]


def test_csv_round_trip(spark, rows, tmp_path):
    data = [(1, 'say "hi",\nthen "go"', None), (2, "plain", "é"), (3, None, "x,y")]
    df = spark.createDataFrame(data, "k int, a string, b string")
    made = sinks.export_queries({"select_things": df, "pair": [df, df.limit(1)]}, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in made] == ["things", "pair_query_1", "pair_query_2"]
    assert rows(sources.read_csv_table(spark, made[0], "k int, a string, b string")) == data
    missing = sources.read_csv_table(spark, str(tmp_path / "none.csv"), "k int")
    assert rows(missing) == [] and missing.columns == ["k"]


def test_sheets_keep_row_numbers(spark, rows, tmp_path):
    (tmp_path / "Main_1.csv").write_text("title,,\n,,\nNo,Code,Name\n" + "".join(f"{i},{i * 10},n\n" for i in range(500)))
    (tmp_path / "Main_2.csv").write_text("only,,\n")
    (tmp_path / "Other.csv").write_text("x,,\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        grid = sources.read_sheets(spark, f"{tmp_path}/Main_*.csv", width=4)
        assert grid.rdd.getNumPartitions() > 3
        got = rows(grid.where("source_file = 'Main_1.csv'").orderBy("row_idx"), "row_idx", "cells")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by_row = dict(got)
    assert sorted(by_row) == list(range(503))
    assert by_row[0] == ["title", None, None, None] and by_row[1] == [None] * 4
    assert all(by_row[i + 3][1] == str(i * 10) for i in range(500))
    assert rows(grid.where("source_file = 'Main_2.csv'"), "row_idx") == [(0,)]
    assert rows(grid.select("source_file").distinct()) == [("Main_1.csv",), ("Main_2.csv",)]


def test_id_lists(spark, tmp_path):
    (tmp_path / "ids.txt").write_text(" 9 \n\n00007\n\t\n9\n")
    got = sources.read_id_list(spark, str(tmp_path / "ids.txt")).orderBy("seq").collect()
    assert [r["id"] for r in got] == ["9", "00007", "9"]
    assert sources.read_id_list(spark, str(tmp_path / "none.txt")).collect() == []


def test_documents_in_two_encodings(spark, rows, tmp_path):
    (tmp_path / "a.b.txt").write_bytes("é審\nx".encode())
    (tmp_path / "c.txt").write_bytes("é".encode("latin-1"))
    assert rows(sources.read_documents(spark, f"{tmp_path}/*.txt")) == [("a.b", "é審\nx"), ("c", "é")]


def test_key_lists(spark, tmp_path):
    df = spark.createDataFrame([(10,), (9,), (None,), (100,), (9,), (0,)], "code int")
    sinks.export_keys(df, f"{tmp_path}/distinct")
    assert lines(tmp_path / "distinct") == ["0", "9", "10", "100"]
    sinks.export_keys(df, f"{tmp_path}/repeated", distinct=False)
    assert lines(tmp_path / "repeated") == ["9", "9", "10", "100"]
    with pytest.raises(ValueError):
        sinks.export_keys(df.withColumn("b", F.lit(1)), f"{tmp_path}/two")


def test_a_hot_repeated_key_sorts_over_several_tasks(spark):
    keys = spark.range(20000).select(F.lit(7).alias("code"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [
            r[1] for r in sinks.sorted_keys(keys, distinct=False).groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20000 and max(sizes) < 10000


def test_per_key_files(spark, rows, tmp_path):
    df = spark.createDataFrame([("00007", "a"), ("00007", "b"), ("8", 'c "d"')], "stock_id string, title string")
    sinks.write_per_key(df, f"{tmp_path}/out")
    assert sorted(p for p in os.listdir(tmp_path / "out") if "=" in p) == ["stock_id=00007", "stock_id=8"]
    back = spark.read.schema("title string, stock_id string").options(header=True, quote='"', escape='"').csv(f"{tmp_path}/out")
    assert rows(back, "stock_id", "title") == [("00007", "a"), ("00007", "b"), ("8", 'c "d"')]


def test_a_hot_key_is_written_by_several_tasks(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "MAX_FILE_ROWS", 100)
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("stock_id"), "id")
    sinks.write_per_key(df, f"{tmp_path}/out")
    files = [f for f in os.listdir(tmp_path / "out" / "stock_id=hot") if f.startswith("part-")]
    assert len(files) > 1
    back = spark.read.schema("id long, stock_id string").option("header", True).csv(f"{tmp_path}/out")
    assert rows(back, "stock_id", "id") == rows(df, "stock_id", "id")


def test_ids_from_file_names(spark, rows, tmp_path):
    for name in ("press_releases_1.csv", "press_releases_a b.csv", "press_releases_.csv", "press_summary.csv"):
        (tmp_path / name).write_text("x")
    assert rows(sources.ids_from_file_names(spark, f"{tmp_path}/*.csv")) == [("1",), ("a b",)]
    assert rows(sources.ids_from_file_names(spark, f"{tmp_path}/none/*.csv")) == []


def test_replaced_table_counts_rows(spark, tmp_path):
    assert sinks.replace_table(spark.range(10), f"{tmp_path}/t") == 10
    assert sinks.replace_table(spark.range(3), f"{tmp_path}/t") == 3
    assert sinks.replace_table(spark.range(0), f"{tmp_path}/t", skip_empty=True) == 0
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3
    assert sinks.replace_table(spark.range(0), f"{tmp_path}/t") == 0
    assert spark.read.parquet(f"{tmp_path}/t").count() == 0


def test_scratch_is_in_the_session_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(base + "/x-")
    small = settle(spark.range(3), "small")
    assert small.count() == 3 and "SinglePartition" not in small._jdf.queryExecution().executedPlan().toString()


TEXTS = {
    "r_20140630": "notes\nskipped\nAudit: qualified  opinion\n",
    "r_20150630": "Emphasis of\nmatter",
    "blank": " \n",
}


def test_stream_equals_batch_over_restarts(spark, rows, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    inbox.mkdir()

    def run():
        documents = stream.document_stream(spark, str(inbox))
        stream.flag_stream(documents, out, checkpoint).awaitTermination()
        return rows(stream.read_flags(spark, out))

    names = sorted(TEXTS)
    (inbox / f"{names[0]}.txt").write_text(TEXTS[names[0]])
    run()
    for name in names[1:]:
        (inbox / f"{name}.txt").write_text(TEXTS[name])
    first = run()
    batch = phrase_flags(slice_documents(spark.createDataFrame(list(TEXTS.items()), "document_name string, text string")))
    assert first == rows(batch)
    # The same document delivered again, under a new file time, adds no row.
    again = inbox / "again"
    again.mkdir()
    assert run() == first
    (inbox / f"{names[1]}.text").write_text(TEXTS[names[1]])
    assert run() == first


def test_a_replayed_batch_replaces_its_rows(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame(list(TEXTS.items()), "document_name string, text string")
    df.write.parquet(str(tmp_path / "docs"))
    for attempt in ("one", "two"):  # a lost checkpoint replays batch 0
        source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "docs"))
        stream.flag_stream(source, out, str(tmp_path / attempt)).awaitTermination()
    assert rows(stream.read_flags(spark, out), "document_name") == [("r_20140630",), ("r_20150630",)]


def test_a_table_in_several_files_is_streamed(spark, rows, tmp_path):
    data = [(i, f"notes\nAudit that {i}\n", "en", f"src{i % 3}", 20) for i in range(6)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame(data, schema)
    df.repartition(3).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "whole"))
    (part,) = (tmp_path / "whole").glob("part-*")
    (tmp_path / "file").mkdir()
    part.rename(tmp_path / "file" / "documents.parquet")
    want = rows(phrase_flags(slice_documents(S.reports(S.Tables(spark, str(tmp_path / "file"))))))
    assert len(want) == 6
    for kind in ("folder", "file"):
        assert rows(QUERIES["streamed_flags"](spark, str(tmp_path / kind))) == want
