"""Row distribution helpers (H1-H5) and the stream-static lookup."""

from pyspark.sql import functions as F

from tidepool.operators import distribution as D


def test_spread_and_fields_keep_rows(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert sorted(r[0] for r in D.spread(df, 5).select("id").collect()) == list(range(100))
    by = D.by_fields(df, ["k"], 4)
    parts = by.select("k", F.spark_partition_id().alias("p")).distinct().collect()
    owner = {}
    for r in parts:
        assert owner.setdefault(r["k"], r["p"]) == r["p"]  # one partition per key


def test_replicate_gives_every_consumer_every_row(spark):
    df = D.replicate(spark.range(50), 3)
    rows = df.select("id", "task", F.spark_partition_id().alias("p")).collect()
    assert sorted((r["id"], r["task"]) for r in rows) == [(i, t) for i in range(50) for t in range(3)]
    assert all(len({r["p"] for r in rows if r["task"] == t}) == 1 for t in range(3))


def test_copies_are_tagged_where_they_lie(spark):
    df = D.copies_for(spark.range(50), 3)
    assert sorted(map(tuple, df.collect())) == [(i, t) for i in range(50) for t in range(3)]
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_the_distribution_asked_for(spark):
    """H1 is a round-robin exchange, H2 a hash exchange on the fields."""
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert "RoundRobinPartitioning(5)" in plan(D.spread(df, 5))
    assert "hashpartitioning(k" in plan(D.by_fields(df, ["k"], 4))
    sizes = [r["count"] for r in D.spread(df, 5).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 8


def test_route_and_consume(spark):
    df = spark.createDataFrame([(1, "error"), (2, "view"), (3, "purchase")], "id long, t string")
    routed = D.route(df, {"alerts": F.col("t") == "error", "commerce": F.col("t") == "purchase"})
    assert {r["id"]: r["stream"] for r in routed.collect()} == {1: "alerts", 2: "default", 3: "commerce"}
    assert [r["id"] for r in D.stream(routed, "alerts").collect()] == [1]
    assert D.stream(routed, "alerts").columns == ["id", "t"]


def test_merge_streams_positional(spark):
    a = spark.createDataFrame([("x y",)], "sentence string")
    b = spark.createDataFrame([("z",)], "word string")
    assert sorted(r[0] for r in D.merge_streams([a, b], ["sentence"]).collect()) == ["x y", "z"]
