"""NULL branches of joins, offers onto parents, HTML in linear time, the stream's state, the entry."""

import os
import random
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.markup import element_bodies
from ledgerloom.operators import joins as J
from ledgerloom.operators.silver import merge_offer_rows
from ledgerloom.streaming import flags as stream

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    spark.range(50).selectExpr(
        "if(id % 3 = 0, null, id) k", "concat('a', id) a", "id b", "repeat('long', 50) text"
    ).write.parquet(f"{tmp_path}/left")
    spark.range(0, 50, 2).selectExpr("id rk", "concat('n', id) name", "id other").write.parquet(f"{tmp_path}/right")
    return spark.read.parquet(f"{tmp_path}/left"), spark.read.parquet(f"{tmp_path}/right")


def schemas(text):
    return [line[line.index("ReadSchema"):] for line in text.splitlines() if "ReadSchema" in line]


@pytest.mark.parametrize("branch", [True, False])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_all_kinds_of_join(spark, rows, tables, how, branch):
    left, right = tables
    got = J.spread_join(left.select("k", "b"), right.select("rk", "name"), [("k", "rk")], how, branch)
    want = left.select("k", "b").join(right.select("rk", "name"), F.col("k") == F.col("rk"), how).drop("rk")
    assert rows(got) == rows(want) and got.columns == want.columns


def test_only_the_columns_asked_for_are_read(tables):
    left, right = tables
    text = plan(J.left_lookup(left, right, [("k", "rk")]).select("k", "name"))
    assert sorted(set(schemas(text))) == ["ReadSchema: struct<k:bigint>", "ReadSchema: struct<rk:bigint,name:string>"]
    assert "spark_partition_id" not in text.lower()
    text = plan(J.keep_listed(left, right, [("k", "rk")], listed=False).select("a"))
    assert sorted(set(schemas(text))) == ["ReadSchema: struct<k:bigint,a:string>", "ReadSchema: struct<rk:bigint>"]


def test_filters_reach_the_scans_of_both_branches(tables):
    left, right = tables
    text = plan(J.left_lookup(left, right, [("k", "rk")]).where("b > 7"))
    assert text.count("GreaterThan(b,7)") == 2
    assert "IsNotNull(k)" in text and "IsNull(k)" in text


def test_null_keys_do_not_shuffle(spark, tables):
    left, right = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = J.left_lookup(left, right, [("k", "rk")])
        text = plan(joined)
        # The union's last child: the rows with NULL keys, from the scan on.
        branch = text[text.index("Filter isnull(k"):]
        assert "Exchange" not in branch and branch.count("Scan") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sequential(rows):
    """The rule as a loop over the rows of one key."""
    kept, parent = [], None
    for key, seq, amount, place in rows:
        place = (place or "").strip()
        if place in ("(b)", "(c)"):
            if parent is None:
                kept.append([key, seq, None, None, None])
            else:
                slot = 3 if place == "(b)" else 4
                if amount is not None:
                    parent[slot] = amount if parent[slot] is None else max(parent[slot], amount)
        else:
            parent = [key, seq, amount, None, None]
            kept.append(parent)
    return [tuple(r) for r in kept]


@pytest.mark.parametrize("width", [5, 1000])
def test_offers_onto_parents(spark, rows, width):
    rnd = random.Random(width)
    data = []
    for key in (1, 2, 3, None):
        for seq in range(60 if key != 3 else 1):
            data.append((key, seq, rnd.choice([None, 1.0, 2.0, 5.0]), rnd.choice(["(a)", " (b)", "(c) ", "(b)", None])))
    df = spark.createDataFrame(data, "stock_code int, seq int, funds_raised double, offer_location string").repartition(4)
    got = rows(merge_offer_rows(df, ["seq"], mode="parent", width=width))
    want = [r for key in (1, 2, 3, None) for r in sequential([d for d in data if d[0] == key])]
    assert got == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    with pytest.raises(ValueError):
        merge_offer_rows(df, ["seq"], mode="sideways")


def loop_bodies(html):
    """Bodies of all <li> by a stack."""
    import re

    tags = [(m.start(), m.end(), m.group().startswith("</")) for m in re.finditer(r"</?li(?=[ />])[^>]*>", html)]
    open_ones, spans = [], []
    for start, end, ends in tags:
        if not ends:
            spans.append([end, len(html)])
            open_ones.append(spans[-1])
        elif open_ones:
            open_ones.pop()[1] = start
    return [html[a:z] for a, z in spans]


def test_elements_against_a_stack(spark):
    rnd = random.Random(5)
    pages = ["", "no tags", "</li></li>x<li>a</li>", "<li><li><li>"]
    pages += ["".join(rnd.choices(["<li>", "</li>", "<li class=x>", "t", "<b>"], k=rnd.randrange(40))) for _ in range(200)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)] + [(-1, None)], "id int, html string")
    got = {r.id: r.bodies for r in df.select("id", element_bodies(F.col("html"), "li").alias("bodies")).collect()}
    assert got.pop(-1) is None
    assert got == {i: loop_bodies(p) for i, p in enumerate(pages)}


def test_elements_take_about_as_long_as_their_number(spark):
    def seconds(tags):
        html = "<li>text</li>" * (tags // 2)
        df = spark.createDataFrame([(html,)], "html string").select(F.size(element_bodies(F.col("html"), "li")))
        df.collect()
        start = time.perf_counter()
        assert df.first()[0] == tags // 2
        return time.perf_counter() - start

    small, large = seconds(4000), seconds(32000)
    assert large < 24 * max(small, 0.05)


def test_a_batch_does_not_read_earlier_output(spark, rows, tmp_path):
    """With the earlier batches' files gone the stream still knows their names."""
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    inbox.mkdir()

    def run():
        stream.flag_stream(stream.document_stream(spark, str(inbox)), out, checkpoint).awaitTermination()

    for i in range(4):
        (inbox / f"r_{20140101 + i}.txt").write_text("Audit: qualified opinion\n")
    run()
    assert stream.read_flags(spark, out).count() == 4
    for i in range(2):
        (inbox / f"r_{20140101 + i}.text").write_text("Audit: qualified opinion\n")  # delivered again
    (inbox / "r_20150101.txt").write_text("adverse opinion\n")
    folder = tmp_path / "out" / "batch_id=0"
    folder.rename(tmp_path / "moved")
    run()
    assert rows(stream.read_flags(spark, out), "document_name") == [("r_20150101",)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


@pytest.mark.parametrize("missing", ["zstandard", "numpy"])
def test_entry_without_a_package_of_the_training_part(tmp_path, missing):
    script = f"""
import sys
sys.modules[{missing!r}] = None
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
assert len(entry.queries()) > 100 and set(entry.oracle_sql()) <= set(entry.queries())
assert not [name for name in entry.queries() if name.startswith("op") and name[2].isdigit()]
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
