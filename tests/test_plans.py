"""What the plans must and must not hold."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from ledgerloom.operators import joins as J
from ledgerloom.operators import reports as R
from ledgerloom.operators import silver as V
from ledgerloom.operators import latest
from ledgerloom.operators.latest import latest_per_key
from ledgerloom.plans import views
from ledgerloom.session import settle
from ledgerloom.sources import files as sources

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(entry_points.QUERIES))
def test_no_pairs_and_no_python(spark, name):
    text = plan(entry_points.queries()[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "ExistingRDD"):
        assert word not in text


@pytest.fixture
def source(spark, tmp_path):
    columns = {
        "gvkey": "'1'", "isin": "cast(id as string)", "conm": "'c'", "datadate": "'2014-12-31'", "fyear": "2014",
        "sales": "1.0", "exchg": "170", "indfmt": "'INDL'", "popsrc": "'I'", "consol": "'C'", "datafmt": "'HIST_STD'",
    }
    spark.range(100).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()]).write.parquet(f"{tmp_path}/g")
    return spark.read.parquet(f"{tmp_path}/g")


def test_filters_and_columns_reach_the_scan(source):
    text = plan(sources.fundamentals(source, views.EXCHANGE | views.INDUSTRIAL, views.ANNUAL_COLUMNS))
    assert "EqualTo(exchg,170)" in text and "EqualTo(datafmt,HIST_STD)" in text
    assert "sales" not in text[text.index("ReadSchema"):]


def test_year_filter_reaches_the_scan_below_the_lookup(spark, tmp_path):
    spark.range(10).selectExpr(
        "'g' gvkey", "'i' isin", "'c' conm", "'d' datadate", "'q' datacqtr", "'q' datafqtr", "2014 fyearq", "4 fqtr", "1 other"
    ).write.parquet(f"{tmp_path}/q")
    master = spark.createDataFrame([(1, "i", "c", "ORD SH")], "stock_code int, isin string, company string, stock_type string")
    dataset = views.firm_dataset(spark.read.parquet(f"{tmp_path}/q"), master)
    text = plan(views.recent_dataset(dataset))
    assert "GreaterThanOrEqual(fyearq,2014)" in text and "other" not in text[text.index("ReadSchema"):]


def test_missing_rows_are_an_anti_join_on_unique_keys(spark):
    left = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    text = plan(J.unmatched_rows(left, left, "k"))
    assert "LeftAnti" in text and text.count("HashAggregate") == 2


@pytest.mark.parametrize("join", ["left", "semi", "anti", "latest"])
def test_a_hot_key_is_split(spark, join):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k")
        rows = spark.range(0, 60000, 1, 8).select(hot, (F.lit(2020) + F.col("id") * 0).alias("d"), F.md5(F.col("id").cast("string")).alias("v"))
        keys = spark.range(0, 60000, 7).select(F.col("id").alias("k"), F.lit("n").alias("name"))
        joined = {
            "left": lambda: J.left_lookup(rows, keys.withColumnRenamed("k", "rk"), [("k", "rk")]),
            "semi": lambda: J.semi_join(rows, keys.unionByName(spark.range(1, 2).selectExpr("id k", "'n' name")), "k"),
            "anti": lambda: J.unmatched_rows(rows, keys.unionByName(keys), "k"),
            "latest": lambda: latest_per_key(rows, "k", "d"),
        }[join]()
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_offers_without_big_groups_shuffle_once(spark):
    offers = spark.range(100).selectExpr("id % 7 stock_code", "id seq", "1.0 funds_raised", "'(b)' offer_location")
    text = plan(V.merge_offer_rows(offers, ["seq"]))
    assert text.count("Exchange") == 1 and text.count("Window ") == 1 and "Join" not in text


def test_texts_are_sliced_once_and_picked_before(spark, tmp_path):
    spark.createDataFrame([("a", "x")], "document_name string, text string").write.parquet(f"{tmp_path}/t")
    documents = spark.read.parquet(f"{tmp_path}/t")
    text = plan(R.phrase_flags(R.slice_documents(documents)))
    assert "Exchange" not in text and text.count("disclaimer (of )?opinion") == 1
    assert text.count("[^\\x00-\\x7F]") == 1
    paths = spark.createDataFrame([("d/a.pdf",)], "pdf_path string")
    joined = plan(R.flag_paths(paths, documents))
    sliced = joined.index("[^\\x00-\\x7F]")
    # The texts asked for are picked before the slicing, by a list sent to them.
    assert "BroadcastHashJoin" in joined[sliced:] and "LeftSemi" in joined[sliced:]
    assert joined[sliced:].count("Exchange hashpartitioning") == 1  # the distinct names


def test_no_size_switches_are_left():
    """Limits stand where they are the feature: the sample and the preview."""
    base = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "ledgerloom")
    for folder in ("operators", "sources", "sinks", "plans", "streaming"):
        for name in os.listdir(os.path.join(base, folder)):
            if name.endswith(".py") and name != "sets.py":
                with open(os.path.join(base, folder, name)) as file:
                    text = file.read()
                for word in (".limit(", "F.broadcast(", "inputFiles(", ".collect()"):
                    assert word not in text, (name, word)


def test_rows_that_are_not_the_latest_do_not_move(spark, tmp_path):
    spark.range(4000).selectExpr("id % 100 AS k", "cast(id div 100 AS string) AS d", "repeat(sha2(cast(id AS string), 256), 4) AS wide").write.parquet(
        f"{tmp_path}/rows"
    )
    spark.range(100).selectExpr("id AS part", "concat('p', id) AS name").write.parquet(f"{tmp_path}/parts")
    parts = spark.read.parquet(f"{tmp_path}/parts")
    wide = spark.read.parquet(f"{tmp_path}/rows").join(parts, F.col("k") == F.col("part"))
    settled = []
    monkey = pytest.MonkeyPatch()
    monkey.setattr(latest, "settle", lambda df, label: settled.append((label, df)) or settle(df, label))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = latest.latest_rows(wide, "k", "d")
        assert sorted((r.k, r.d, r.name) for r in got.collect()) == sorted((i, "9", f"p{i}") for i in range(100))
        text = plan(dict(settled)["latest-rows"])
        assert text.index("getbit") > text.index("Join [k") and "wide" in text
    finally:
        monkey.undo()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
