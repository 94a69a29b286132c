"""Reach and the word-count read path on the reference's example data."""

import pytest
from pyspark.sql import functions as F

from tidepool.operators import counts as C
from tidepool.operators import generators as G
from tidepool.operators import reach as RE
from sentences import FIXED_BATCH_SENTENCES

# The reference's example lookup tables (the three requested
# pages are keyed by their path only; reach depends on the graph alone).
TWEETERS = {
    "blog/1": ["sally", "bob", "tim", "george", "nathan"],
    "blog/5": ["adam", "david", "sally", "nathan"],
    "blog/123": ["tim", "mike", "john"],
}
FOLLOWERS = {
    "sally": ["bob", "tim", "alice", "adam", "jim", "chris", "jai"],
    "bob": ["sally", "nathan", "jim", "mary", "david", "vivian"],
    "tim": ["alex"],
    "nathan": ["sally", "bob", "adam", "harry", "chris", "vivian", "emily", "jordan"],
    "adam": ["david", "carissa"],
    "mike": ["john", "bob"],
    "john": ["alice", "nathan", "jim", "mike", "bob"],
}


@pytest.fixture
def graph(spark):
    hop1 = spark.createDataFrame([(u, t) for u, ts in TWEETERS.items() for t in ts], "url string, tweeter string")
    hop2 = spark.createDataFrame([(t, f) for t, fs in FOLLOWERS.items() for f in fs], "tweeter string, follower string")
    urls = list(TWEETERS) + ["notaurl.com", "aaa"]
    req = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "request_id long, url string")
    return req, hop1, hop2


@pytest.mark.parametrize("method", ["distinct", "uniquer", "group_one", "lists"])
def test_reach_example(spark, graph, method):
    out = {r["request_id"]: r["reach"] for r in RE.reach(*graph, method=method).collect()}
    assert out == {0: 16, 1: 14, 2: 7, 3: 0, 4: 0}


def test_hot_follower_list(spark):
    """One account that every request reaches and a third of all followers hang on."""
    req = spark.range(60).select(F.col("id").alias("request_id"), F.col("id").cast("string").alias("url"))
    hop1 = req.select("url", F.lit("hot").alias("tweeter")).unionByName(req.select("url", F.concat(F.lit("t"), "url").alias("tweeter")))
    hop2 = (spark.range(500).select(F.lit("hot").alias("tweeter"), F.col("id").alias("follower"))
            .unionByName(spark.range(1000).select(F.concat(F.lit("t"), (F.col("id") % 60).cast("string")).alias("tweeter"),
                                                  (F.col("id") + 400).alias("follower"))))
    own = {t: len({*range(500), *[i + 400 for i in range(1000) if i % 60 == t]}) for t in range(60)}
    assert {r["request_id"]: r["reach"] for r in RE.reach(req, hop1, hop2).collect()} == own
    # every request by lists, every request by pairs, and some of each (1000 rows over 60 accounts: 516 or 517 paths)
    for most in (4_096, 0, 516):
        assert {r["request_id"]: r["reach"] for r in RE.reach(req, hop1, hop2, method="lists", most=most).collect()} == own


@pytest.mark.parametrize("most", [0, 3, 100])
def test_reach_by_lists_with_nulls_and_repeats(spark, most):
    req = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, None), (None, "a"), (0, "b")], "request_id long, url string")
    hop1 = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "z"), ("b", None), (None, "x")], "url string, tweeter string")
    hop2 = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", 2), ("y", None), ("z", None), (None, 7)], "tweeter string, follower long")
    rows = [sorted((tuple(r) for r in RE.reach(req, hop1, hop2, method=m, most=most).collect()), key=repr) for m in ("distinct", "lists")]
    assert rows[0] == rows[1] and dict(rows[0])[0] == 2


def test_reach_approx_close(spark, graph):
    out = {r["request_id"]: r["reach"] for r in RE.reach(*graph, method="approx").collect()}
    assert abs(out[0] - 16) <= 1 and out[3] == 0


def test_word_count_and_query(spark):
    s = spark.createDataFrame([(x,) for x in FIXED_BATCH_SENTENCES], "sentence string")
    words = G.tokens(s, "sentence", "java")
    assert words.count() == 36
    counts = C.word_count(words)
    got = {r["word"]: r["count"] for r in counts.collect()}
    assert len(got) == 28 and got["the"] == 5 and got["to"] == 3 and got["and"] == 2 and got["be"] == 2
    req = spark.createDataFrame([(0, "cat the dog jumped"), (1, "zzz")], "request_id long, args string")
    rw = G.tokens(req, "args", "java", keep=("request_id",))
    found, sums = RE.lookup_sum(rw, counts, requests=req)
    assert {r["request_id"]: r["sum"] for r in sums.collect()} == {0: 6, 1: 0}
    assert sorted(r["word"] for r in found.collect()) == ["jumped", "the"]


def test_duplicate_request_words_each_count(spark):
    counts = spark.createDataFrame([("the", 5)], "word string, count long")
    rw = spark.createDataFrame([(0, "the"), (0, "the")], "request_id long, word string")
    _, sums = RE.lookup_sum(rw, counts)
    assert sums.collect()[0]["sum"] == 10
