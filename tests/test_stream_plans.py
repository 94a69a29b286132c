"""The streaming jobs of plans/streams.py end to end."""

import tempfile

import pyarrow as pa
from pyspark.sql import functions as F

from tidepool.operators import counts as C
from tidepool.operators.ordered import id_chunk
from tidepool.plans import streams as P
from sentences import FIXED_BATCH_SENTENCES
from tidepool.streaming.sources import feed_stream
from tidepool.streaming.versioned import BatchOutput, VersionedStore, bucket_counter

from test_streaming import _ckpt, _feeds

SENT = pa.schema([("seq", pa.int64()), ("sentence", pa.string())])


def _sentence_feeds():
    rows = list(enumerate(FIXED_BATCH_SENTENCES))
    return _feeds([rows[0:3], rows[3:5]], SENT)  # batches of at most 3 sentences


def test_persistent_word_count_and_query(spark):
    root = tempfile.mkdtemp(prefix="tidepool-wc-")
    store = VersionedStore(spark, f"{root}/state", "key string, count long")
    s = feed_stream(spark, _sentence_feeds(), "seq long, sentence string")
    P.persistent_word_count_job(s, store, "pwc", checkpoint=_ckpt())
    counts = {r["key"]: r["count"] for r in store.latest().collect()}
    assert len(counts) == 28 and counts["the"] == 5 and counts["to"] == 3
    req = spark.createDataFrame([(1, "cat the dog jumped"), (2, "")], "request_id long, args string")
    got = {r["request_id"]: r["sum"] for r in P.words_query(req, store).collect()}
    assert got == {1: 6, 2: 0}
    batch = {r["word"]: r["count"] for r in P.word_count_batch(
        spark.createDataFrame(list(enumerate(FIXED_BATCH_SENTENCES)), "seq long, sentence string")).collect()}
    assert batch == counts


def test_running_word_count_stream_equals_batch(spark):
    s = feed_stream(spark, _sentence_feeds(), "seq long, sentence string")
    out = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-rwc-"))
    P.running_word_count_job(s, out, "rwc", checkpoint=_ckpt())
    got = sorted((r["seq"], r["pos"], r["word"], r["count"]) for r in out.read().collect())
    flat = spark.createDataFrame(list(enumerate(FIXED_BATCH_SENTENCES)), "seq long, sentence string")
    toks = flat.select("seq", F.posexplode(F.split("sentence", " ", -1)).alias("pos", "word"))
    exp = C.running_count(toks, "word", ["seq", "pos"], id_chunk("seq", 2))
    assert got == sorted((r["seq"], r["pos"], r["word"], r["count"]) for r in exp.collect())


def test_transactional_jobs(spark):
    root = tempfile.mkdtemp(prefix="tidepool-tx-")
    parts = {0: ["cat", "dog", "chicken", "cat", "dog", "apple"], 1: ["cat", "dog", "apple", "banana"],
             2: ["cat"] * 5 + ["dog"] * 4}
    batches = []
    for b in range(3):
        rows = []
        for p, ws in parts.items():
            rows += [(p * 100 + i, w) for i, w in enumerate(ws) if b * 3 <= i < b * 3 + 3]
        batches.append(rows)
    d = _feeds(batches, pa.schema([("id", pa.int64()), ("word", pa.string())]))
    out = BatchOutput(spark, f"{root}/gc")
    P.transactional_global_count_job(feed_stream(spark, d, "id long, word string"),
                                     VersionedStore(spark, f"{root}/g", "count long"), out, "tgc",
                                     checkpoint=_ckpt())
    assert {r["batch_id"]: r["global_count"] for r in out.read().collect()} == {0: 9, 1: 16, 2: 19}
    cl, bo = BatchOutput(spark, f"{root}/cl"), BatchOutput(spark, f"{root}/bo")
    P.transactional_words_job(feed_stream(spark, d, "id long, word string"),
                              VersionedStore(spark, f"{root}/c", "key string, count long"),
                              VersionedStore(spark, f"{root}/b", "bucket long, count long"), cl, bo, "tw2",
                              checkpoint=_ckpt())
    assert sorted((r["batch_id"], r["bucket"], r["count"]) for r in bo.read().collect()) == [(0, 0, 4), (1, 0, 5)]
    assert cl.read().filter("batch_id = 2").collect()[0]["count"] == 7


def test_rolling_top_words_job_equals_flagship(spark):
    import datetime as dt
    from test_streaming import _as_rows, _events_with_sentinel
    from tidepool.plans.catalog import rolling_top_words
    from tidepool.streaming.sources import event_time
    stream, ev = _events_with_sentinel(spark)
    out = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-rtw-"))
    P.rolling_top_words_job(event_time(stream), out, "rtw_job", "event_type", "ts", 9 * 3600, 3 * 3600, 5,
                            F.lit(dt.datetime(2024, 1, 1)), "1 hour", checkpoint=_ckpt())
    got = out.read().filter("obj <> '__sentinel__'").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "rank", "obj", "count",
        "actual_window_length_seconds", "is_partial_window")
    exp = rolling_top_words(spark, "/root/testdata/sf0.001").select(
        "window_start", "rank", "obj", "count", "actual_window_length_seconds", "is_partial_window")
    assert _as_rows(got) == _as_rows(exp)


def test_single_join_job(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    g = _feeds([[(i, "male" if i % 2 == 0 else "female", t0) for i in range(10)]],
               pa.schema([("id", pa.int64()), ("gender", pa.string()), ("g_ts", pa.timestamp("us"))]))
    a = _feeds([[(i, i + 20, t0 + dt.timedelta(seconds=i)) for i in range(9, -1, -1)]],
               pa.schema([("id", pa.int64()), ("age", pa.int64()), ("a_ts", pa.timestamp("us"))]))
    from tidepool.streaming.sources import event_time
    gs = event_time(feed_stream(spark, g, "id long, gender string, g_ts timestamp_ntz"), "g_ts")
    as_ = event_time(feed_stream(spark, a, "id long, age long, a_ts timestamp_ntz"), "a_ts")
    out = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-sj-"))
    P.single_join_job(gs, as_, out, "sj_job", ["id"], "g_ts", "a_ts", 60, "1 minute", ["gender", "age"],
                      checkpoint=_ckpt())
    got = sorted((r["age"], r["gender"]) for r in out.read().collect())
    assert got == [(20 + i, "male" if i % 2 == 0 else "female") for i in range(10)]


def test_reach_requests_stream(spark):
    from test_reach import FOLLOWERS, TWEETERS
    hop1 = spark.createDataFrame([(u, t) for u, ts in TWEETERS.items() for t in ts], "url string, tweeter string")
    hop2 = spark.createDataFrame([(t, f) for t, fs in FOLLOWERS.items() for f in fs], "tweeter string, follower string")
    urls = list(TWEETERS)
    d = _feeds([[(0, urls[0]), (1, urls[1])], [(2, urls[2]), (3, "unknown")]],
               pa.schema([("request_id", pa.int64()), ("url", pa.string())]))
    for method in ("distinct", "group_one"):
        out = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-reach-"))
        P.reach_requests_job(feed_stream(spark, d, "request_id long, url string"), hop1, hop2, out,
                             f"reach_stream_{method}", method=method, checkpoint=_ckpt())
        got = {r["request_id"]: (r["batch_id"], r["reach"]) for r in out.read().collect()}
        assert got == {0: (0, 16), 1: (0, 14), 2: (1, 7), 3: (1, 0)}


def test_suffix_and_exclaim_jobs(spark):
    d = _feeds([[(0, "nathan")], [(1, "bob")]], pa.schema([("id", pa.int64()), ("word", pa.string())]))
    words = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-suffix-"))
    P.suffix_job(feed_stream(spark, d, "id long, word string"), words, "exclaim_stream", checkpoint=_ckpt())
    assert sorted(r["word"] for r in words.read().collect()) == ["bob!!!!!!", "nathan!!!!!!"]
    r = _feeds([[(1, "hello"), (2, "goodbye")]], pa.schema([("request_id", pa.int64()), ("args", pa.string())]))
    out = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-ex-"))
    P.exclaim_requests_job(feed_stream(spark, r, "request_id long, args string"), out, "req_ex", checkpoint=_ckpt())
    assert {x["request_id"]: x["result"] for x in out.read().collect()} == {1: "hello!", 2: "goodbye!"}
    out3 = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-ex3-"))
    P.exclaim_requests_job(feed_stream(spark, r, "request_id long, args string"), out3, "req_ex3", text="!!!",
                           result_first=True, checkpoint=_ckpt())
    assert {x["return_info"]: x["result"] for x in out3.read().collect()} == {1: "hello!!!", 2: "goodbye!!!"}


def test_two_merged_sources_are_counted_together(spark):
    one = _feeds([[(0, "a b")], [(2, "b c")]], SENT)
    two = _feeds([[(1, "b b")], [(3, "a")]], SENT)
    streams = [feed_stream(spark, d, "seq long, sentence string") for d in (one, two)]
    out = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-merge-"))
    P.running_word_count_job(streams, out, "rwc2", checkpoint=_ckpt())
    rows = out.read().collect()
    assert {w: max(r["count"] for r in rows if r["word"] == w) for w in "abc"} == {"a": 2, "b": 4, "c": 1}
    assert sorted((r["word"], r["count"]) for r in rows) == [("a", 1), ("a", 2), *[("b", i) for i in (1, 2, 3, 4)], ("c", 1)]


def test_requests_for_word_sums_arrive_as_a_stream(spark):
    root = tempfile.mkdtemp(prefix="tidepool-wq-")
    store = VersionedStore(spark, f"{root}/state", "key string, count long")
    P.persistent_word_count_job(feed_stream(spark, _sentence_feeds(), "seq long, sentence string"), store, "pwc2",
                                checkpoint=_ckpt())
    d = _feeds([[(1, "cat the dog jumped")], [(2, ""), (3, "to the")]],
               pa.schema([("request_id", pa.int64()), ("args", pa.string())]))
    out = BatchOutput(spark, f"{root}/out")
    P.words_query_job(feed_stream(spark, d, "request_id long, args string"), store, out, "wq", checkpoint=_ckpt())
    assert {r["request_id"]: r["sum"] for r in out.read().collect()} == {1: 6, 2: 0, 3: 8}


def test_jobs_keep_running_on_their_period(spark):
    import time
    r = _feeds([[(1, "hello")]], pa.schema([("request_id", pa.int64()), ("args", pa.string())]))
    out = BatchOutput(spark, tempfile.mkdtemp(prefix="tidepool-run-"))
    q = P.exclaim_requests_job(feed_stream(spark, r, "request_id long, args string"), out, "req_run",
                               available_now=False, every="200 milliseconds", checkpoint=_ckpt())
    try:
        end = time.time() + 60
        while time.time() < end and not q.recentProgress:
            time.sleep(0.2)
        q.processAllAvailable()
        assert q.isActive
        assert [x["result"] for x in out.read().collect()] == ["hello!"]
    finally:
        q.stop()


def test_null_keys_and_missing_markers(spark):
    """Counts of a null key go on from batch to batch, and no marker file is needed."""
    root = tempfile.mkdtemp(prefix="tidepool-null-")
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        counts = VersionedStore(spark, f"{root}/c", "key string, count long")
        buckets = VersionedStore(spark, f"{root}/b", "bucket long, count long")
        body = bucket_counter(counts, buckets, "word")
        for v in range(3):
            body(spark.createDataFrame([("a",), (None,)], "word string"), v)
        assert sorted(map(str, map(tuple, counts.read(2).collect()))) == ["('a', 3)", "(None, 3)"]
        assert [tuple(r) for r in buckets.read(2).collect()] == [(0, 2)]
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
