import random

from pyspark.sql import functions as F

from termloom.operators import skew
from termloom.operators.ranking import number_rows, top_n


def test_salted_join_equals_a_join(spark):
    """One key holds over a third of the rows; the lookup has some keys twice and some not at all."""
    random.seed(1)
    rows = [("hot", i) for i in range(3000)] + [(f"k{random.randrange(500)}", i) for i in range(5000)]
    left = spark.createDataFrame(rows, "key string, spread int")
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), *((f"k{i}", i) for i in range(0, 500, 2))], "key string, v int"
    )
    sizes = left.groupBy("key").count()
    hot = skew.hot_keys(sizes, "key", "count").cache()
    splits = {r["key"]: r["splits"] for r in hot.collect()}
    assert 1500 <= splits["hot"] <= 1600
    assert len(splits) < skew.HOT_KEYS
    joined = skew.salted_join(left, right, hot, "key", "spread")
    expected = left.join(right, "key")
    assert joined.columns == ["key", "spread", "v"]
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, expected.collect()))


def test_join_of_two_skewed_sides(spark):
    random.seed(4)
    left = spark.createDataFrame(
        [("hot", i) for i in range(400)] + [("wide", 1)] + [(f"k{i % 50}", i) for i in range(600)], "key string, a int"
    )
    right = spark.createDataFrame(
        [("hot", i) for i in range(30)] + [("wide", i) for i in range(300)] + [(f"k{i % 70}", i) for i in range(140)],
        "key string, b int",
    )
    splits = skew.hot_keys(left.groupBy("key").count(), "key", "count").where("splits > 100")
    copies = skew.hot_keys(right.groupBy("key").count(), "key", "count").withColumnRenamed("splits", "copies")
    hot = splits.join(copies.where("copies > 100"), "key", "full").cache()
    factors = {r["key"]: (r["splits"], r["copies"]) for r in hot.collect()}
    assert set(factors) == {"hot", "wide"} and factors["wide"][0] is None
    joined = skew.salted_join(left, right, hot, "key", "a", "b")
    assert joined.columns == ["key", "a", "b"]
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "key").collect()))


def test_rows_of_a_hot_key_are_divided(spark):
    left = spark.range(4000).select(F.lit("hot").alias("key"), F.col("id").alias("spread"))
    hot = skew.hot_keys(spark.createDataFrame([("hot", 4000), ("x", 5000)], "key string, n long"), "key", "n")
    lookup = spark.createDataFrame([("hot", 1)], "key string, v int")
    joined = skew.salted_join(left, lookup, hot, "key", "spread")
    assert joined.count() == 4000
    splits = {r["key"]: r["splits"] for r in hot.collect()}["hot"]
    salts = left.select(F.pmod(F.xxhash64("spread"), F.lit(splits)).alias("s")).groupBy("s").count()
    assert salts.agg(F.max("count")).first()[0] < 20


def test_number_rows(spark):
    random.seed(2)
    values = random.sample(range(10**6), 5000)
    frame = spark.createDataFrame([(v,) for v in values], "v long").repartition(13)
    numbered = {r["v"]: r["n"] for r in number_rows(frame, "v", name="n").collect()}
    assert numbered == {v: i for i, v in enumerate(sorted(values))}
    assert number_rows(frame, F.col("v").desc(), name="n").orderBy("n").first()["v"] == max(values)


def test_number_rows_of_nothing(spark):
    assert number_rows(spark.range(0), "id").collect() == []


def test_top_n_by_window_and_by_sort(spark):
    """One query has nearly all rows; ties everywhere."""
    random.seed(3)
    rows = [(0 if i % 10 else i % 7, f"d{i:05d}", float(random.randrange(20))) for i in range(4000)]
    scored = spark.createDataFrame(rows, "query_id int, id string, relevance double")
    expected = []
    for query in range(7):
        own = sorted((r for r in rows if r[0] == query), key=lambda r: (-r[2], r[1]))
        expected += [(q, i, rank) for rank, (q, i, _) in enumerate(own, 1)]
    for n in (1, 30, 1500, 10_000):
        found = top_n(scored, n).select("query_id", "id", "rank").collect()
        assert sorted(map(tuple, found)) == sorted(r for r in expected if r[2] <= n)


def test_best_of_many_tasks_are_ranked_in_groups(spark, monkeypatch):
    rows = spark.range(2000, numPartitions=25).select(
        (F.col("id") % 3).alias("query_id"), F.col("id").cast("string").alias("id"), (F.col("id") % 97).cast("double").alias("relevance")
    )
    want = sorted(map(tuple, ranking.top_n(rows, 6).collect()))
    monkeypatch.setattr(ranking, "ONE_LEVEL", 4)
    grouped = ranking.top_n(rows, 6, tasks=25)
    assert sorted(map(tuple, grouped.collect())) == want and len(want) == 18
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "SPARK_PARTITION_ID" in plan


def test_commonest_keys_of_a_large_lookup_are_broadcast(spark, monkeypatch):
    from termloom.operators import skew

    rows = spark.range(1000).select(F.expr("CAST(least(id % 50, 10) AS STRING)").alias("key"), F.col("id").alias("row"))
    lookup = rows.groupBy("key").agg(F.count("*").alias("n")).withColumn("value", F.concat(F.lit("v"), "key"))
    want = sorted(map(tuple, skew.lookup_join(rows, lookup, "key", "n", "row").collect()))
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 200)
    joined = skew.lookup_join(rows, lookup, "key", "n", "row")
    assert "Union" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, joined.collect())) == want and len(want) == 1000
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 1)
    assert sorted(map(tuple, skew.lookup_join(rows, lookup, "key", "n", "row").collect())) == want
