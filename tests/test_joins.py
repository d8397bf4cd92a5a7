"""Matching, latest records and the relational views on small tables."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.functions.cells import key_column
from ledgerloom.operators import joins as J
from ledgerloom.operators import latest as L
from ledgerloom.operators import sets
from ledgerloom.operators.silver import build_isin_master
from ledgerloom.plans import views


@pytest.fixture(params=["broadcast", "shuffle"])
def either_join(spark, request):
    """Run with small sides sent to the tasks, and with every join shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if request.param == "broadcast" else "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_left_lookup_keeps_null_keys(spark, rows, either_join):
    left = spark.createDataFrame([(1, 10), (None, 20), (2, 30), (2, 30), (3, None)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "rk long, name string")
    assert rows(J.left_lookup(left, right, [("k", "rk")])) == [
        (None, 20, None), (1, 10, "a"), (2, 30, "b"), (2, 30, "b"), (2, 30, "c"), (2, 30, "c"), (3, None, None)
    ]


def test_left_lookup_on_a_malformed_key(spark, rows, either_join):
    left = spark.createDataFrame([(1,), (12,)], "k long")
    right = spark.createDataFrame([("001", "a"), ("x12", "b")], "rk string, name string")
    with pytest.raises(TypeError):
        J.left_lookup(left, right, [("k", "rk")])
    numbers = right.withColumn("rk", key_column(right, "rk"))
    assert rows(J.left_lookup(left, numbers, [("k", "rk")])) == [(1, "a"), (12, None)]


@pytest.mark.parametrize("left, right, values, keys, found", [
    ("int", "double", [7, 8], [7.5, 8.0], [8]),
    ("double", "int", [7.5, 8.0], [7, 8], [8.0]),
    ("bigint", "decimal(10,1)", [7, 8], ["7.5", "8.0"], [8]),
    ("int", "bigint", [7], [7 + (1 << 32)], []),
    ("date", "timestamp", ["2020-01-01", "2020-01-02"], ["2020-01-01 12:00:00", "2020-01-02 00:00:00"], ["2020-01-02"]),
])
def test_keys_of_two_types(spark, rows, either_join, left, right, values, keys, found):
    one = spark.createDataFrame([(str(v),) for v in values], "k string").select(F.col("k").cast(left))
    other = spark.createDataFrame([(str(k),) for k in keys], "rk string").select(F.col("rk").cast(right))
    kept = J.keep_listed(one, other, [("k", "rk")]).select(F.col("k").cast("string"))
    assert [r[0] for r in rows(kept)] == [str(f) for f in found]
    lost = J.keep_listed(one, other, [("k", "rk")], listed=False).count()
    assert lost == len(values) - len(found)


def test_left_lookup_spreads_null_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(2000).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v"))
        right = spark.range(5).select(F.col("id").alias("rk"), F.lit("x").alias("name"))
        joined = J.left_lookup(left, right, [("k", "rk")])
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_left_lookup_on_two_keys(spark, rows, either_join):
    left = spark.createDataFrame([(1, "q"), (1, None), (None, "q")], "k int, q string")
    right = spark.createDataFrame([(1, "q", 5), (1, None, 6)], "rk int, rq string, n int")
    assert rows(J.left_lookup(left, right, [("k", "rk"), ("q", "rq")])) == [
        (None, "q", None), (1, None, None), (1, "q", 5)
    ]


def test_unmatched_rows_keep_null_keys(spark, rows, either_join):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "k int, n string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(J.unmatched_rows(left, right, "k")) == [(None, "c"), (2, "b"), (2, "b")]
    assert rows(J.unmatched_rows(left, right, "k", ["n"])) == [("b",), ("c",)]


def test_match_report(spark, rows, either_join):
    left = spark.createDataFrame([("i1", "g1"), ("i2", "g1"), ("i3", "g2"), (None, "g3")], "isin string, gvkey string")
    right = spark.createDataFrame([("i1", 1), ("i1", 2), ("i9", 2)], "isin string, code int")
    assert rows(J.match_report(left, right, "isin", ["isin", "gvkey"], ["isin", "code"])) == [
        ("left", "gvkey", 3, 1, 3, 1 / 3),
        ("left", "isin", 3, 1, 2, 1 / 3),
        ("right", "code", 2, 2, 1, 1.0),
        ("right", "isin", 2, 1, 1, 0.5),
    ]


def test_latest_keeps_ties_and_skips_null_dates(spark, rows, either_join):
    df = spark.createDataFrame(
        [(1, "2020-01-01", "a"), (1, "2021-01-01", "b"), (1, "2021-01-01", "c"), (2, None, "d"), (3, None, "e"), (3, "2019", "f")],
        "k int, d string, n string",
    )
    assert rows(L.latest_per_key(df, "k", "d"), "k", "n") == [(1, "b"), (1, "c"), (3, "f")]
    left = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    assert rows(L.latest_join(left, df, ("c", "k"), "d"), "c", "n") == [(None, None), (1, "b"), (1, "c"), (2, None)]


def test_one_per_group_has_null_group(spark, rows):
    df = spark.createDataFrame([(1, None, 5), (1, None, 4), (1, "q", 1), (2, None, 9)], "g int, q string, v int")
    assert rows(L.one_per_group(df, ["g", "q"], ["v"])) == [(1, None, 4), (1, "q", 1), (2, None, 9)]


def test_one_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = L.one_per_group(df, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before


def listing(spark, data):
    return spark.createDataFrame(data, "stock_code int, isin string, company string, stock_type string")


def test_entity_master(spark, rows):
    a = listing(spark, [(1, "I1", "A", "ORD SH"), (1, None, "B", "ORD SH"), (2, "I2", "C", "WARRANT")])
    b = listing(spark, [(1, "I1", "Z", "ORD SH"), (1, None, "A", "ORD SH"), (3, "I1", None, "ORD SH")])
    assert rows(sets.entity_master([a, b])) == [
        (1, None, "B", "ORD SH"), (1, "I1", "Z", "ORD SH"), (3, "I1", None, "ORD SH")
    ]
    assert rows(views.isin_keys([a, b])) == [(None,), ("I1",)]


def quarter(spark, data):
    return spark.createDataFrame(
        data,
        "gvkey string, isin string, conm string, datadate string, datacqtr string, datafqtr string, fyearq int, fqtr int",
    )


def test_dataset_repeats_firms_with_two_codes(spark, rows):
    fq = quarter(spark, [("001", "I1", "F", "2014-03-31", "2014Q1", "2014Q1", 2014, 1),
                         ("002", None, "G", "2013-03-31", "2013Q1", "2013Q1", 2013, 1)])
    master = listing(spark, [(1, "I1", "A", "ORD SH"), (2, "I1", "B", "ORD SH"), (3, None, "C", "ORD SH")])
    dataset = views.firm_dataset(fq, master)
    assert rows(dataset, "cs_gvkey", "hkex_stock_code") == [("001", 1), ("001", 2), ("002", None)]
    assert rows(views.recent_dataset(dataset), "cs_gvkey") == [("001",), ("001",)]


def test_documents_exist_by_text_or_by_date(spark, rows):
    dataset = spark.createDataFrame([(1, 2014), (2, 2014), (3, 2014), (4, 2013), (5, 2014)], "hkex_stock_code int, cs_fyearq int")
    documents = spark.createDataFrame(
        [(1, "2014-01-01", None), (2, "31/12/2013", ""), (3, None, "2013-12-31"), (4, "2020-01-01", None)],
        "har_stock_code int, har_announcement_date string, aof_report_date string",
    )
    by_text = views.dataset_with_documents(dataset, documents)
    assert rows(by_text, "hkex_stock_code") == [(1,), (2,)]
    by_date = views.dataset_with_documents(dataset, documents, formats=("yyyy-MM-dd", "dd/MM/yyyy"))
    assert rows(by_date, "hkex_stock_code") == [(1,)]


def test_classified_quarters(spark, rows):
    fq = quarter(
        spark,
        [("001234", "I1", "F", "2014-12-31", "2014Q4", "2014Q4", 2014, 4),
         ("001234", "I0", "F", "2014-12-31", "2014Q4", "2014Q4", 2014, 4),
         ("001234", "I1", "F", "2014-11-30", "2014Q4", "2014Q4", 2014, 4),
         ("001234", "I1", "F", "2015-03-31", None, "2015Q1", 2015, 1),
         ("x12", "I2", "G", "2014-12-31", "2014Q4", "2014Q4", 2014, 4)],
    )
    opinions = spark.createDataFrame(
        [(7, 1234, "2014Q4", 4, 1, 0, 0, 0, 0, None), (8, 1234, "2014Q4", 3, 1, 1, 1, 1, 1, "not year end")],
        "hkex_stock_code int, cs_gvkey int, cs_datacqtr string, cs_fqtr int, aof_qualified_op int, aof_adverse_op int, "
        "aof_disclaimer_op int, aof_emphasis_op int, aof_material_unc_op int, `Unnamed: 16` string",
    )

    def board(own, data):
        columns = [*views.SHARED_LISTING_COLUMNS, *own]
        return spark.createDataFrame(
            [tuple({"stock_code": c, "listing_date": d, "sponsors": s}.get(n, f"{n}") for n in columns) for c, d, s in data],
            ", ".join(f"{n} {'int' if n == 'stock_code' else 'string'}" for n in columns),
        )

    gem = board(views.GEM_LISTING_COLUMNS, [(7, "2001-01-01", "old"), (7, "2002-01-01", None), (9, None, "x")])
    main = board(views.MAIN_LISTING_COLUMNS, [(7, "2000-01-01", "main"), (7, "2000-01-01", "tie")])
    got = views.classified_firm_quarters(fq, opinions, gem, main)
    assert len(got.columns) == 8 + 7 + 26
    assert rows(got, "gvkey", "datacqtr", "isin", "aof_qualified_op", "hk_listing_date", "hk_sponsors") == [
        ("001234", None, "I1", None, None, None),
        ("001234", "2014Q4", "I0", 1, "2002-01-01", "main"),
        ("001234", "2014Q4", "I0", 1, "2002-01-01", "tie"),
        ("x12", "2014Q4", "I2", None, None, None),
    ]


def test_isin_master_repeats_names(spark, rows):
    agency = spark.createDataFrame([(1, "I1"), (2, "I2")], "stock_code int, isin string")
    exchange = spark.createDataFrame([(1, "I3", "W")], "stock_code int, isin string, stock_type string")
    names = spark.createDataFrame([(1, "a"), (1, "b")], "stock_code int, hkex_co_name string")
    got = build_isin_master(agency, exchange, names)
    assert rows(got, "stock_code", "isin", "stock_type", "hkex_co_name") == [
        (1, "I1", None, "a"), (1, "I1", None, "b"), (1, "I3", "W", "a"), (1, "I3", "W", "b"), (2, "I2", None, None)
    ]


def test_yearly_panel(spark, rows):
    df = spark.createDataFrame([(2015, "a", 1), (2015, "a", 0), (2015, "b", None), (2016, "a", 1)], "y int, g string, q int")
    assert rows(sets.yearly_panel(df, "y", "g", "q")) == [(2015, 2, 3, 0.5), (2016, 1, 1, 1.0)]


def test_codes(spark):
    df = spark.createDataFrame([(7999,), (8000,), (8999,), (9000,), (None,)], "c int")
    assert [r[0] for r in df.select(codes.market_class(F.col("c"))).collect()] == ["SEHK", "GEM", "GEM", "SEHK", "SEHK"]
    flags = spark.createDataFrame([(0, 0, 0), (1, 0, 0), (1, 1, 0)], "a int, b int, c int")
    unclear = codes.is_unclear(F.col("a"), F.col("b"), F.col("c"))
    assert [r[0] for r in flags.select(unclear).collect()] == [1, 0, 1]


def test_sample_is_repeatable(spark, rows):
    df = spark.range(1000)
    first = rows(sets.random_sample(df, "id", 50, seed=3))
    assert first == rows(sets.random_sample(df.repartition(7), "id", 50, seed=3)) and len(first) == 50
    assert first != rows(sets.random_sample(df, "id", 50, seed=4))
    assert len(rows(sets.random_sample(spark.range(5), "id", 50))) == 5
