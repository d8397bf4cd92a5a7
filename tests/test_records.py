"""Quoted records read by blocks, against Python's reader; tables replaced whole."""

import csv
import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom.session import scratch_scope, settle
from ledgerloom.sinks import files as sinks
from ledgerloom.sources import files as sources
from ledgerloom.sources.records import read_records


@pytest.fixture
def small_blocks(spark):
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def written(rows, end):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def records(spark, folder):
    found = {}
    for r in read_records(spark, str(folder)).collect():
        found.setdefault(r.source_file, {})[r.record_no] = r.record
    assert all(sorted(f) == list(range(len(f))) for f in found.values())
    return {name: [f[i] for i in range(len(f))] for name, f in found.items()}


CELLS = ["", "x", "a,b", 'say "hi"', '"', '""', "two\nlines", "\n\n", 'end"\n"', ',\n",', "é審\n", "7' pipe", "z" * 90]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_many_blocks(spark, small_blocks, tmp_path, end):
    rnd = random.Random(4)
    files = {}
    for name in ("a.csv", "b.csv", "c.csv"):
        files[name] = [[str(i), *rnd.choices(CELLS, k=3)] for i in range(150)]
        (tmp_path / name).write_bytes(written(files[name], end).encode())
    found = records(spark, tmp_path)
    for name, rows in files.items():
        assert [next(csv.reader(io.StringIO(r, newline=""))) for r in found[name]] == rows
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20


def test_same_as_the_reader_that_takes_files_whole(spark, rows, small_blocks, tmp_path):
    rnd = random.Random(7)
    data = [["k", "a", "b"]] + [[str(i), *rnd.choices(CELLS[1:], k=2)] for i in range(300)]
    (tmp_path / "t.csv").write_bytes(written(data, "\n").encode())
    schema = "k int, a string, b string"
    whole = spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path))
    assert rows(sources.read_csv_table(spark, str(tmp_path), schema)) == rows(whole)


def test_quotes_inside_plain_cells_are_text(spark, small_blocks, tmp_path):
    lines = ['1,5" pipe,x', '2,"a', 'b",y', '3,q"uo"te,"c""', '",z', "", "4,plain,w", '5,"open', "to the end"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    assert records(spark, tmp_path)["t.csv"] == [
        lines[0], "\n".join(lines[1:3]), "\n".join(lines[3:5]), lines[6], "\n".join(lines[7:])
    ]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.text('a",\n é', max_size=12), min_size=2, max_size=3), min_size=1, max_size=40), st.integers(1, 90))
def test_any_table(spark, tmp_path_factory, table, block):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "t.csv").write_bytes(written(table, "\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        found = records(spark, folder)["t.csv"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [next(csv.reader(io.StringIO(r, newline=""))) for r in found] == table


def test_sheets_with_line_ends_in_cells(spark, rows, small_blocks, tmp_path):
    (tmp_path / "Main_1.csv").write_text('t,,\n"a\nb",1,\n' + "".join(f'{i},"x,{i}\ny",\n' for i in range(60)))
    grid = sources.read_sheets(spark, f"{tmp_path}/Main_*.csv", multi_line=True)
    got = rows(grid.orderBy("row_idx"), "row_idx", "cells")
    assert got[0] == (0, ["t", None, None]) and dict(got)[1] == ["a\nb", "1", None]
    assert all(dict(got)[i + 2] == [str(i), f"x,{i}\ny", None] for i in range(60))


def failing(df):
    return df.select(F.when(F.col("id") < 7, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path, kind):
    target = f"{tmp_path}/t" if kind == "folder" else "replaced_whole"

    def read():
        return spark.read.parquet(target) if kind == "folder" else spark.table(target)

    try:
        assert sinks.replace_table(spark.range(5), target) == 5
        with pytest.raises(Exception, match="lost"):
            sinks.replace_table(failing(spark.range(0, 100, 1, 4)), target)
        assert read().count() == 5
        # A table may be replaced by a query on itself.
        assert sinks.replace_table(read().where("id > 1"), target) == 3
        assert sorted(r.id for r in read().collect()) == [2, 3, 4]
        if kind == "folder":
            assert [p.name for p in tmp_path.iterdir()] == ["t"]
    finally:
        if kind == "table":
            spark.sql("DROP TABLE IF EXISTS replaced_whole")


def test_a_failed_export_leaves_the_old_one(spark, rows, tmp_path):
    sinks.export_queries({"select_a": spark.range(3)}, str(tmp_path))
    with pytest.raises(Exception, match="lost"):
        sinks.export_queries({"select_a": failing(spark.range(9))}, str(tmp_path))
    assert rows(sources.read_csv_table(spark, f"{tmp_path}/a", "id bigint")) == [(0,), (1,), (2,)]


def test_documents_as_files(spark, rows, tmp_path):
    target = str(tmp_path / "docs")
    data = [("007", "two\nlines\n"), ("a/b c+d%", "é審"), ("z=1", ""), ("none", None)]
    df = spark.createDataFrame(data, "document_name string, text string")
    assert sinks.write_documents(df, target) == 4
    want = sorted((n, t or "", None) for n, t in data)
    assert rows(sources.read_written_documents(spark, target)) == want
    latin = spark.createDataFrame([("l", "Größe é")], df.schema)
    sinks.write_documents(latin, target, encoding="ISO-8859-1")  # replaces both parts
    assert rows(sources.read_written_documents(spark, target)) == [("l", "Größe é", None)]
    for bad, said in (([("x", "a"), ("x", "b")], "two documents named x"), ([(None, "a")], "without a name")):
        with pytest.raises(Exception, match=said):
            sinks.write_documents(spark.createDataFrame(bad, df.schema), target)
    assert rows(sources.read_written_documents(spark, target)) == [("l", "Größe é", None)]


def test_documents_lost_or_changed_are_reported(spark, rows, tmp_path):
    target = tmp_path / "docs"
    df = spark.createDataFrame([(n, f"text {n}") for n in "abc"], "document_name string, text string")
    sinks.write_documents(df, str(target))
    (lost,) = (target / "files" / "document_name=a").glob("part-*")
    lost.unlink()
    (changed,) = (target / "files" / "document_name=b").glob("part-*")
    changed.with_name("." + changed.name + ".crc").unlink(missing_ok=True)
    changed.write_text("text x\n")
    more = target / "files" / "document_name=d"
    more.mkdir()
    (more / "part-0.txt").write_text("not on the list\n")
    assert rows(sources.read_written_documents(spark, str(target))) == [
        ("a", None, "not there"), ("b", None, "not as it was written"), ("c", "text c", None)
    ]


def test_scratch_goes_with_its_scope(spark):
    before = settle(spark.range(2), "kept")
    with scratch_scope(spark):
        inner = settle(spark.range(3), "gone")
        assert inner.count() == 3
        folder = inner.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        assert os.path.isdir(folder.replace("///", "/"))
    assert not os.path.isdir(folder.replace("///", "/")) and before.count() == 2


def test_a_document_is_one_file_in_either_store(spark, rows, tmp_path, monkeypatch):
    data = [("007", "two\nlines\n"), ('a/b "c"+d%[x]^', "é審"), ("z=1", ""), ("none", None)]
    df = spark.createDataFrame(data, "document_name string, text string")
    monkeypatch.setattr(sinks, "MAX_FILE_ROWS", 2)
    per_key = spark.createDataFrame(
        [(k, i, v) for i, v in enumerate(["a", None, "", 'say "x",\tthen', " b "]) for k in ("1", "x y:z", "", None)],
        "stock_id string, n int, title string",
    )
    found = []
    for kind in ("mounted", "other"):
        if kind == "other":  # Spark's writers
            monkeypatch.setattr(sinks, "_mounted", lambda spark, folder: None)
        target = tmp_path / kind
        sinks.write_documents(df, f"{target}/docs")
        sinks.write_per_key(per_key, f"{target}/keys")
        back = sources.read_per_key(spark, f"{target}/keys", "n int, title string, stock_id string")
        found.append((
            rows(sources.read_written_documents(spark, f"{target}/docs")), rows(back),
            sorted(p.name for p in (target / "docs/files").iterdir() if "=" in p.name),
            sorted(p.name for p in (target / "keys").iterdir() if "=" in p.name),
        ))
        if kind == "mounted":  # and no file of checksums, mode or success beside it
            assert [len(list(p.iterdir())) for p in (target / "docs/files").iterdir()] == [1] * 4
    assert found[0] == found[1] and len(found[0][1]) == 20


def test_the_driver_does_not_list_documents(spark, rows, tmp_path, monkeypatch):
    target = tmp_path / "docs"
    data = [(str(i), f"é {i}\n" * i) for i in range(30)]
    data += [(n, "x") for n in ("", "__HIVE_DEFAULT_PARTITION__", "a/b%[c]", "_u", "twice", "hidden", "inner", "gone", "long")]
    sinks.write_documents(spark.createDataFrame(data, "document_name string, text string"), str(target))
    own = lambda name: target / "files" / f"document_name={name}"
    (own("twice") / "more.txt").write_text("y\n")
    for name in ("inner", "gone", "hidden"):
        (part,) = own(name).glob("part-*")
        if name == "inner":
            (own(name) / "deep").mkdir()
            (own(name) / "deep" / "_kept").mkdir()
            (own(name) / "deep" / "_kept" / "part.txt").write_text("x\n")
            (own(name) / "deep" / part.name).write_text("x\n")
        part.unlink()
        if name != "inner":
            (own(name) / "_part.txt").write_text("x\n")
            (own(name) / ".part.txt").write_text("x\n")
    own("gone").joinpath("_part.txt").unlink()
    own("gone").joinpath(".part.txt").unlink()
    own("gone").rmdir()
    (part,) = own("long").glob("part-*")
    part.write_text("x\nx")
    back = sources.read_written_documents(spark, str(target))
    assert not [f for f in back.inputFiles() if "/files/" in f]
    assert back.rdd.getNumPartitions() == 4  # and tasks do not grow with the files
    got = rows(back)
    monkeypatch.setattr(sources, "_mounted", lambda spark, folder: None)
    assert got == rows(sources.read_written_documents(spark, str(target)))  # by Spark's reader
    wrong = {(n, e) for n, _, e in got if e}
    missing = {(n, "not there") for n in ("", "__HIVE_DEFAULT_PARTITION__", "hidden", "gone")}
    assert wrong == missing | {("twice", "not as it was written"), ("long", "not as it was written")}
    assert len(got) == len(data) + 1 and ("29", "é 29\n" * 29, None) in got


def test_documents_without_their_folder_are_an_error(spark, tmp_path):
    sinks.write_documents(spark.createDataFrame([("a", "x")], "document_name string, text string"), str(tmp_path))
    (tmp_path / "files").rename(tmp_path / "aside")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sources.read_written_documents(spark, str(tmp_path))
