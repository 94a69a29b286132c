"""Totals as a log of changes, the running count of hot words on it, and queries against live state."""

import itertools
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepool.operators.changelog import bucket_changelog, bucket_deltas, count_changelog
from tidepool.operators.counts import word_count
from tidepool.operators.generators import tokens
from tidepool.operators.reach import lookup_sum
from tidepool.streaming.deltalog import DeltaLog, logged_bucket_counter, logged_counter, running_count_batches
from tidepool.streaming.livestate import live_counts, live_counts_job, live_words_query
from tidepool.streaming.runner import run_foreach_batch
from tidepool.streaming.sources import feed_stream
from tidepool.streaming.versioned import BatchOutput

ROWS = "batch_id long, id long, key int"


@pytest.fixture
def root(scratch):
    return f"{scratch}/{uuid.uuid4().hex}"


def batches(n=7, seed=0):
    rng, ids = random.Random(seed), itertools.count()
    return [[(b, next(ids), rng.choice([None, 1, 1, 1, 2, 30, b])) for _ in range(rng.randint(1, 12))] for b in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_changelog_and_buckets_equal_the_batch_form(spark, root):
    got_counts, got_buckets = DeltaLog(spark, f"{root}/c", "key int", every=3, slices=4), DeltaLog(spark, f"{root}/b", "bucket long", every=3, slices=2)
    body, all_rows = logged_bucket_counter(got_counts, got_buckets, "key", size=3), batches(4)
    for v, rows in enumerate(all_rows):
        body(spark.createDataFrame(rows, ROWS), v)
    df = spark.createDataFrame([r for rows in all_rows for r in rows], ROWS)
    changes = count_changelog(df, "key")
    buckets = bucket_changelog(bucket_deltas(changes, 3))
    assert dict(got_counts.delta(0).dtypes)["key"] == "int"  # keys keep their type
    for v in range(len(all_rows)):
        assert rows_of(got_counts.delta(v)) == rows_of(changes.where(F.col("batch_id") == v).select("key", "count", "prev_count"))
        assert rows_of(got_buckets.delta(v).select("bucket", "count")) == rows_of(buckets.where(F.col("batch_id") == v).select("bucket", "count"))
    assert rows_of(got_counts.latest()) == rows_of(df.groupBy("key").count())


def test_any_batch_between_two_bases_can_be_replayed(spark, root):
    log, all_rows = DeltaLog(spark, root, "key int", every=4, slices=4), batches(8, 1)
    body = logged_counter(log, "key")
    for v, rows in enumerate(all_rows):
        body(spark.createDataFrame(rows, ROWS), v)
    deltas, state = [rows_of(log.delta(v)) for v in range(8)], rows_of(log.latest())
    for v in (7, 4, 3):  # those that write a base too
        body(spark.createDataFrame(all_rows[v], ROWS), v)
    assert [rows_of(log.delta(v)) for v in range(8)] == deltas and rows_of(log.latest()) == state
    log.prune()
    body(spark.createDataFrame(all_rows[7], ROWS), 7)
    assert rows_of(log.latest()) == state
    with pytest.raises(RuntimeError, match="no delta of batch"):
        body(spark.createDataFrame(all_rows[2], ROWS), 2)


def test_a_batch_writes_only_its_keys(spark, root):
    log = DeltaLog(spark, root, "key int", every=2, slices=8)
    body = logged_counter(log, "key")
    body(spark.range(500).selectExpr("0L batch_id", "id", "cast(id as int) key"), 0)
    body(spark.range(500).selectExpr("1L batch_id", "id", "cast(id as int) key"), 1)
    body(spark.createDataFrame([(2, 0, 7)], ROWS), 2)
    body(spark.createDataFrame([], ROWS), 3)
    assert rows_of(log.delta(2)) == [(7, 3, 2)] and log.delta(3).count() == 0
    # the state that batch 2 asks for is read from one folder of the base
    slices = [r[0] for r in spark.createDataFrame([(7,)], "key int").select(log._slice()).collect()]
    assert 0 < log.state(1, slices).count() < 200
    assert log.latest().count() == 500 and log.latest().agg(F.sum("count")).first()[0] == 1001


def test_empty_log(spark, root):
    assert DeltaLog(spark, root, "key int").latest().count() == 0


def test_running_count_of_a_hot_word(spark, root):
    log, out = DeltaLog(spark, f"{root}/log", "word string", every=2, slices=4), BatchOutput(spark, f"{root}/out")
    rng, seen, want = random.Random(3), Counter(), {}
    body = running_count_batches(log, "word", ["id"], out, chunks=4)
    for v in range(3):
        rows = [(v * 200 + i, "hot" if rng.random() < 0.5 else rng.choice([None, "a", f"w{v}"])) for i in range(200)]
        for i, w in rows:
            seen[w] += 1
            want[i] = seen[w]
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "id long, word string")
        body(df, v)
        if v % 2:  # a replay changes nothing
            body(df, v)
    assert {r["id"]: r["count"] for r in out.read().collect()} == want


def test_running_count_job_over_a_stream(spark, root):
    for v in range(3):
        spark.range(v * 10, v * 10 + 10).selectExpr("id", "if(id % 2 = 0, 'hot', concat('w', id % 3)) word") \
            .coalesce(1).write.mode("append").parquet(f"{root}/in")
    log, out = DeltaLog(spark, f"{root}/log", "word string", every=2), BatchOutput(spark, f"{root}/out")
    run_foreach_batch(feed_stream(spark, f"{root}/in", "id long, word string"), "hot_words", running_count_batches(log, "word", ["id"], out),
                      checkpoint=f"{root}/ck")
    got = out.read()
    assert got.count() == 30
    for r in got.groupBy("word").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("count")).alias("c")).collect():
        assert r["c"] == list(range(1, r["n"] + 1))


def test_query_reads_the_live_state_while_the_writer_runs(spark, root):
    texts = ["the cat and the dog", "the man jumped", "cat food"]
    requests = spark.createDataFrame([(0, "cat the dog"), (1, "zzz")], "request_id long, args string")

    def feed(k):
        spark.createDataFrame([(texts[k],)], "sentence string").coalesce(1).write.mode("append").parquet(f"{root}/in")

    def expected(k):
        words = tokens(spark.createDataFrame([(t,) for t in texts[:k + 1]], "sentence string"), "sentence", "java")
        return rows_of(lookup_sum(tokens(requests, "args", "java", keep=("request_id",)), word_count(words), requests=requests)[1])

    feed(0)
    words = tokens(feed_stream(spark, f"{root}/in", "sentence string"), "sentence", "java")
    q = live_counts_job(words, "word", f"live_{uuid.uuid4().hex}", checkpoint=f"{root}/ck", every="0 seconds")
    try:
        for k in range(3):
            if k:
                feed(k)
            q.processAllAvailable()
            assert q.isActive and rows_of(live_words_query(requests, f"{root}/ck")) == expected(k)
        assert {r["word"]: r["count"] for r in live_counts(spark, "word", f"{root}/ck").collect()}["the"] == 3
        assert rows_of(live_words_query(requests, f"{root}/ck", batch_id=0)) == expected(0)
    finally:
        q.stop()
