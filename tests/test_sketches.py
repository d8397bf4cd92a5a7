"""Filters of keys, positions over all rows, and the search for near vectors."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import similarity
from ledgerloom.operators.positions import running_total
from ledgerloom.operators.reports import texts_for_paths
from ledgerloom.operators.similarity import nearest_vectors
from ledgerloom.operators.sketches import key_filter, may_be_key
from ledgerloom.session import settle


def test_a_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    keys = keys.unionByName(spark.createDataFrame([(None,)], "key string"))
    words = settle(key_filter(keys, "key", bits=1 << 16), "filter")
    rows = spark.range(9000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None)], "id bigint, key string"))
    found = {r.id for r in rows.where(may_be_key(words, F.col("key"), bits=1 << 16)).collect()}
    wanted = set(range(0, 3000, 3))
    assert wanted <= found and len(found - wanted) < 100 and -1 not in found
    none = settle(key_filter(keys.where("false"), "key", bits=1 << 16), "filter")
    assert rows.where(may_be_key(none, F.col("key"), bits=1 << 16)).count() == 0


def test_texts_that_nobody_wants_do_not_move(spark, tmp_path):
    spark.range(4000).select(
        F.concat(F.lit("r"), "id").alias("document_name"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("text")
    ).write.parquet(f"{tmp_path}/texts")
    texts = spark.read.parquet(f"{tmp_path}/texts")
    paths = spark.range(0, 4000, 40).select(F.concat(F.lit("d/r"), "id", F.lit(".pdf")).alias("pdf_path"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = texts_for_paths(paths, texts)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "getbit" in plan[plan.index("Exchange hashpartitioning"):]
        assert sorted(r.document_name for r in found.collect()) == sorted(f"r{i}" for i in range(0, 4000, 40))
        exchanged = []

        def walk(node):
            if node.nodeName().startswith("Exchange"):
                metrics = node.metrics()
                exchanged.append(metrics.get("shuffleBytesWritten").get().value())
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))
            if node.nodeName() == "AdaptiveSparkPlan":
                walk(node.executedPlan())
            if "QueryStage" in node.nodeName():
                walk(node.plan())

        walk(found._jdf.queryExecution().executedPlan())
        whole = texts.select(F.sum(F.length("text"))).first()[0]
        assert exchanged and sum(exchanged) < whole / 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("rows", [0, 1, 500])
def test_running_total(spark, rows):
    rnd = random.Random(rows)
    data = [(f"f{i:05d}", rnd.randrange(100)) for i in range(rows)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "name string, n int").repartition(5)
    out = running_total(df, "name", "n", "before")
    got = {r.name: r.before for r in out.collect()}
    total = 0
    for name, n in sorted(data):
        assert got[name] == total
        total += n
    assert len(got) == rows and out.columns == ["name", "n", "before"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan[: plan.index("Window")]


def brute(vectors, queries, k):
    def cosine(a, b):
        size = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
        return round(sum(x * y for x, y in zip(a, b)) / size, 6) if size else 0.0

    out = []
    for q, a in queries:
        scored = sorted(((-cosine(a, b), i) for i, b in vectors), key=lambda s: (s[0], s[1]))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], start=1)]
    return sorted(out)


def test_nearest_vectors_equal_brute_force(spark):
    rnd = random.Random(9)
    centres = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    vectors = [(i, [x + rnd.gauss(0, 0.05) for x in centres[i % 12]]) for i in range(900)]
    vectors += [(900 + i, list(vectors[i][1])) for i in range(20)] + [(1000, [0.0] * 8), (1001, [0.0] * 8)]
    queries = vectors[::50] + [(5000, [0.0] * 8), (5001, [-x for x in centres[0]])]
    given = spark.createDataFrame(vectors + [(None, [1.0] * 8), (7000, None)], "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame(queries + [(7001, None)], "query_id bigint, embedding array<double>")
    found, took = nearest_vectors(given, asked, 7)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score + 0.0) for r in found.collect())
    want = brute(vectors, queries, 7)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) <= 1.1e-6 for g, w in zip(got, want))
    assert took.first().compared < 0.5 * len(vectors) * len(queries)


def test_nearest_vectors_of_few_and_none(spark):
    schema = "vec_id bigint, embedding array<double>"
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    found, took = nearest_vectors(spark.createDataFrame([(5, [2.0, 0.0]), (6, [0.0, 3.0])], schema), asked, 5)
    assert [(r.rank, r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(1, 5, 1.0), (2, 6, 0.0)]
    found, took = nearest_vectors(spark.createDataFrame([], schema), asked, 5)
    assert found.count() == 0 and took.first().compared == 0


def test_near_vectors_come_from_blocks_and_not_pair_by_pair(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 100)
    monkeypatch.setattr(similarity, "QUERY_ROWS", 10)
    monkeypatch.setattr(similarity, "SCORES", 300)
    rnd = random.Random(4)
    vectors = [(i, [rnd.gauss(0, 1) for _ in range(16)]) for i in range(1000)]
    vectors += [(1000 + i, list(vectors[0][1])) for i in range(200)]  # copies of a query
    queries = vectors[:1000:40]
    given = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(3)
    asked = spark.createDataFrame(queries, "query_id bigint, embedding array<double>")
    found, took = nearest_vectors(given, asked, 3)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found.collect()) == [w[:3] for w in brute(vectors, queries, 3)]
    assert took.first().compared > 3 * len(queries)
    ranked = []

    def walk(node):
        if "Window" == node.nodeName():
            ranked.append(node)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(found._jdf.queryExecution().sparkPlan())
    assert ranked and "FlatMapCoGroupsInArrow" in ranked[0].toString()  # the rows that are ranked are the best of blocks
