"""Property tests: the chunked ordered helpers equal the plain window
functions for any chunk width, including one hot key holding most rows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators.ordered import id_chunk, quantile_chunk, running_lag, running_total


def _data(spark, seed, n, keys):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.6 else rnd.choice(keys)
        rows.append((i, k, rnd.randint(0, 5)))
    return spark.createDataFrame(rows, "id long, k string, v long")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), width=st.integers(1, 60), n=st.integers(0, 150))
def test_running_total_matches_window(spark, seed, width, n):
    df = _data(spark, seed, n, ["a", "b", None])
    w = Window.partitionBy("k").orderBy("id")
    exp = df.select("id", F.row_number().over(w).alias("c"), F.sum("v").over(w).alias("s"))
    got_c = running_total(df, ["k"], ["id"], id_chunk("id", width), "c").select("id", "c")
    got_s = running_total(df, ["k"], ["id"], id_chunk("id", width), "s", value="v").select("id", "s")
    e = {r["id"]: (r["c"], r["s"]) for r in exp.collect()}
    gc = {r["id"]: r["c"] for r in got_c.collect()}
    gs = {r["id"]: r["s"] for r in got_s.collect()}
    assert gc == {k: v[0] for k, v in e.items()}
    assert gs == {k: v[1] for k, v in e.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), width=st.integers(1, 40), n=st.integers(0, 120), k=st.integers(0, 5))
def test_running_lag_matches_window(spark, seed, width, n, k):
    df = _data(spark, seed, n, ["a", "b", None])
    w = Window.partitionBy("k").orderBy("id")
    exp = {r["id"]: r["l"] for r in df.select("id", F.lag("v", k).over(w).alias("l")).collect()} if k else \
        {r["id"]: r["v"] for r in df.collect()}
    got = {r["id"]: r["l"] for r in running_lag(df, ["k"], ["id"], id_chunk("id", width), "v", k, "l").collect()}
    assert got == exp


def test_global_running_total(spark):
    df = spark.range(1000).withColumnRenamed("id", "i")
    got = running_total(df, [], ["i"], id_chunk("i", 37), "pos")
    assert all(r["pos"] == r["i"] + 1 for r in got.collect())


def test_bad_widths():
    with pytest.raises(ValueError):
        id_chunk("x", 0)


def test_hot_key_at_scale_matches_closed_form(spark):
    """300k rows, a third of them on one key: the hot key's running count at
    id is id // 3 + 1; every other key holds a few hundred rows."""
    df = spark.range(300_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"))
    out = running_total(df, ["k"], ["id"], id_chunk("id", 10_000), "c")
    bad = out.filter((F.col("k") == "hot") & (F.col("c") != F.floor(F.col("id") / 3) + 1)).count()
    assert bad == 0
    assert out.filter(F.col("k") == "hot").agg(F.max("c")).collect()[0][0] == 100_000
    assert out.count() == 300_000


def _largest_chunk(df, chunk):
    return chunk.attach(df, "c").groupBy("c").count().agg(F.max("count"), F.count("*")).first()


@pytest.mark.parametrize("kind", ["hashed ids", "outlier", "burst"])
def test_quantile_chunks_hold_equal_shares(spark, kind):
    """Sparse ids, one row far away, and nine tenths of the rows in a thousandth of the time."""
    n = 20_000
    col = {"hashed ids": "abs(xxhash64(id))", "outlier": "if(id = 0, -50000000000, id)",
           "burst": "if(id % 10 = 0, id * 1000, 5000000 + id)"}[kind]
    df = spark.range(n).selectExpr("id", f"{col} as o", "if(id % 5 < 3, 'hot', concat('k', id % 7)) as k")
    chunk = quantile_chunk(df, "o", 16)
    most, chunks = _largest_chunk(df, chunk)
    assert chunks >= 15 and most <= 2 * n / 16
    w = Window.partitionBy("k").orderBy("o", "id")
    exp = df.select("id", F.row_number().over(w).alias("c"))
    got = running_total(df, ["k"], ["o", "id"], chunk, "c").select("id", F.col("c").cast("int").alias("c"))
    assert exp.exceptAll(got).count() == 0 and got.count() == n


def test_quantile_chunks_of_times_with_an_outlier_and_nulls(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=i)) for i in range(4000)] + [(4000, dt.datetime(1970, 1, 1)), (4001, None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    most, chunks = _largest_chunk(df, quantile_chunk(df, "ts", 32))
    assert chunks >= 30 and most < 400
    got = running_lag(df.where("ts is not null"), [], ["ts", "id"], quantile_chunk(df, "ts", 32), "id", 2, "l")
    assert {r["id"]: r["l"] for r in got.collect()}[4000] is None
    assert {r["id"]: r["l"] for r in got.collect()}[3999] == 3997
    assert quantile_chunk(df.limit(0), "ts", 4) is not None
    assert running_total(df.limit(0), [], ["id"], quantile_chunk(df.limit(0), "id", 4), "n").count() == 0


def test_building_runs_no_job(spark):
    """The quantiles are a subquery of the plan, not a job while it is built."""
    df = spark.range(100).selectExpr("id", "raise_error('ran') as o")
    out = running_total(df, [], ["id"], quantile_chunk(df, "o"), "n")
    assert "o" in out.columns
    with pytest.raises(Exception, match="ran"):
        out.collect()
