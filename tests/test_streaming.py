"""Streaming bodies: batch == stream, and replaying a micro-batch changes nothing."""

import datetime as dt
import os
import tempfile
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidepool.operators import counts as C
from tidepool.operators import joins as J
from tidepool.operators import ranking as R
from tidepool.operators import windows as W
from tidepool.operators.ordered import id_chunk
from tidepool.streaming.runner import run_available, run_foreach_batch
from tidepool.streaming.sources import event_time, feed_stream, table_stream
from tidepool.streaming.stateful import ranking_each_batch, running_count_stream
from tidepool.streaming.versioned import BatchOutput, VersionedStore, bucket_counter, global_counter

SF = "/root/testdata/sf0.001"


def _feeds(batches, schema: pa.Schema):
    """Write each batch as one parquet file, in order (distinct mtimes)."""
    d = tempfile.mkdtemp(prefix="tidepool-feed-")
    base = time.time() - 1000
    for i, rows in enumerate(batches):
        cols = list(zip(*rows)) if rows else [[] for _ in schema]
        table = pa.table({f.name: pa.array(c, type=f.type) for f, c in zip(schema, cols)})
        p = os.path.join(d, f"feed_{i:04d}.parquet")
        pq.write_table(table, p)
        os.utime(p, (base + i, base + i))
    return d


def _ckpt():
    return tempfile.mkdtemp(prefix="tidepool-ck-")


WORDS = pa.schema([("id", pa.int64()), ("word", pa.string())])


def test_running_count_stream_equals_batch(spark):
    batches = [[(i, f"w{i % 3}") for i in range(b * 10, b * 10 + 10)] for b in range(3)]
    d = _feeds(batches, WORDS)
    s = feed_stream(spark, d, "id long, word string")
    run_available(running_count_stream(s, "word", ["id"]), "rc_stream", checkpoint=_ckpt())
    got = {r["id"]: r["count"] for r in spark.sql("SELECT * FROM rc_stream").collect()}
    flat = spark.createDataFrame([r for b in batches for r in b], "id long, word string")
    exp = {r["id"]: r["count"] for r in C.running_count(flat, "word", ["id"], id_chunk("id", 7)).collect()}
    assert got == exp


# The reference's per-partition example data, fed 3 per partition per batch.
PARTS = {0: ["cat", "dog", "chicken", "cat", "dog", "apple"], 1: ["cat", "dog", "apple", "banana"],
         2: ["cat"] * 5 + ["dog"] * 4}


def _transactional_batches():
    out = []
    for b in range(3):
        rows = []
        for p, ws in PARTS.items():
            rows += [(p * 100 + i, w) for i, w in enumerate(ws) if b * 3 <= i < b * 3 + 3]
        out.append(rows)
    return out


def test_global_counter_with_replay(spark):
    root = tempfile.mkdtemp(prefix="tidepool-state-")
    store = VersionedStore(spark, f"{root}/state", "count long")
    out = BatchOutput(spark, f"{root}/out")
    body = global_counter(store, out)
    d = _feeds(_transactional_batches(), WORDS)
    run_foreach_batch(feed_stream(spark, d, "id long, word string"), "gc", body, checkpoint=_ckpt())
    got = {r["batch_id"]: (r["count"], r["global_count"]) for r in out.read().collect()}
    assert got == {0: (9, 9), 1: (7, 16), 2: (3, 19)}
    # replay the last batch (the only one Spark can re-run): same version, same output
    replay = spark.createDataFrame(_transactional_batches()[2], "id long, word string")
    body(replay, 2)
    got2 = {r["batch_id"]: (r["count"], r["global_count"]) for r in out.read().collect()}
    assert got2 == got
    assert store.latest().collect()[0]["count"] == 19
    # batch 0's state is pruned: re-running batch 1 now must fail, not restart from zero
    with pytest.raises(RuntimeError, match="no state of batch 0"):
        body(spark.createDataFrame(_transactional_batches()[1], "id long, word string"), 1)


def test_words_and_buckets_with_replay(spark):
    root = tempfile.mkdtemp(prefix="tidepool-state-")
    counts = VersionedStore(spark, f"{root}/counts", "key string, count long")
    buckets = VersionedStore(spark, f"{root}/buckets", "bucket long, count long")
    cl, bo = BatchOutput(spark, f"{root}/changelog"), BatchOutput(spark, f"{root}/bucket_out")
    body = bucket_counter(counts, buckets, "word", cl, bo)
    d = _feeds(_transactional_batches(), WORDS)
    run_foreach_batch(feed_stream(spark, d, "id long, word string"), "tw", body, checkpoint=_ckpt())
    body(spark.createDataFrame(_transactional_batches()[2], "id long, word string"), 2)  # replay
    got = {(r["batch_id"], r["key"]): (r["prev_count"], r["count"]) for r in cl.read().collect()}
    assert got == {
        (0, "apple"): (None, 1), (0, "cat"): (None, 5), (0, "chicken"): (None, 1), (0, "dog"): (None, 2),
        (1, "apple"): (1, 2), (1, "banana"): (None, 1), (1, "cat"): (5, 8), (1, "dog"): (2, 4),
        (2, "dog"): (4, 7),
    }
    assert sorted((r["batch_id"], r["bucket"], r["count"]) for r in bo.read().collect()) == [(0, 0, 4), (1, 0, 5)]
    assert {r["key"]: r["count"] for r in counts.latest().collect()} == {
        "apple": 2, "banana": 1, "cat": 8, "chicken": 1, "dog": 7}


def write_sentinel(spark, path, schema, ts, obj):
    """A bounded input ends without moving the watermark past its last windows;
    this far-future row does, so append mode flushes them (tests only)."""
    import datetime
    far = {ts: datetime.datetime(2100, 1, 1), obj: "__sentinel__"}
    row = tuple(far.get(f.name) for f in schema.fields)
    spark.createDataFrame([row], schema).write.mode("append").parquet(path)


def _events_with_sentinel(spark):
    """sf0.001 events plus one far-future row that pushes the watermark past
    every real window, so append mode flushes them all."""
    d = tempfile.mkdtemp(prefix="tidepool-ev-")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.write.mode("overwrite").parquet(d)
    write_sentinel(spark, d, ev.schema, "ts", "event_type")
    return spark.readStream.schema(ev.schema).parquet(d), ev


def _as_rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_sliding_slots_stream_equals_batch(spark):
    stream, ev = _events_with_sentinel(spark)
    s = W.sliding_count_slots(event_time(stream), "event_type", "ts", 6 * 3600, 3600, watermark="1 hour")
    run_available(s, "w7_stream", checkpoint=_ckpt())
    got = spark.sql("SELECT * FROM w7_stream").filter("obj <> '__sentinel__'") \
        .select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                F.col("window_end").cast("timestamp_ntz").alias("window_end"), "obj", "count")
    exp = W.sliding_count(ev, "event_type", "ts", 6 * 3600, 3600)
    assert _as_rows(got) == _as_rows(exp)


def test_rolling_top_words_stream_equals_batch(spark):
    stream, ev = _events_with_sentinel(spark)
    start = ev.agg(F.min("ts")).collect()[0][0]
    s0 = dt.datetime(start.year, start.month, start.day, (start.hour // 3) * 3)
    counts = W.rolling_count(event_time(stream), "event_type", "ts", 9 * 3600, 3 * 3600,
                             stream_start=F.lit(s0), watermark="1 hour")
    root = tempfile.mkdtemp(prefix="tidepool-rank-")
    out = BatchOutput(spark, root)
    # The sentinel must reach the watermark: a filter on it before the sink would be
    # pushed below the watermark node, so its windows are dropped from the output instead.
    run_foreach_batch(counts, "rtw", ranking_each_batch(out, ["window_start"], "obj", "count", 5),
                      checkpoint=_ckpt())
    got = out.read().filter("obj <> '__sentinel__'").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "rank", "obj", "count",
                            "actual_window_length_seconds")
    b = W.rolling_count(ev, "event_type", "ts", 9 * 3600, 3 * 3600)
    exp = R.rank_per_group(b, ["window_start"], "obj", "count", 5).select(
        "window_start", "rank", "obj", "count", "actual_window_length_seconds")
    assert _as_rows(got) == _as_rows(exp)


def test_interval_join_stream_equals_batch(spark):
    stream, ev = _events_with_sentinel(spark)
    st = event_time(stream)
    a = st.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("a_ts")).withWatermark("a_ts", "1 hour")
    b = st.filter("event_type = 'click'").select("user_id", F.col("ts").alias("b_ts")).withWatermark("b_ts", "1 hour")
    run_available(J.interval_join(a, b, ["user_id"], "a_ts", "b_ts", 3600), "ij_stream", checkpoint=_ckpt())
    got = spark.sql("SELECT user_id, CAST(a_ts AS timestamp_ntz) a_ts, CAST(b_ts AS timestamp_ntz) b_ts FROM ij_stream")
    ab = ev.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("a_ts"))
    bb = ev.filter("event_type = 'click'").select("user_id", F.col("ts").alias("b_ts"))
    exp = J.interval_join(ab, bb, ["user_id"], "a_ts", "b_ts", 3600).select("user_id", "a_ts", "b_ts")
    assert _as_rows(got) == _as_rows(exp) and got.count() > 0


def test_table_stream_reads_one_table(spark):
    s = table_stream(spark, SF, "events", max_files_per_trigger=1)
    run_available(s.select("event_id"), "tbl_stream", checkpoint=_ckpt())
    assert spark.sql("SELECT count(*) FROM tbl_stream").collect()[0][0] == spark.read.parquet(f"{SF}/events.parquet").count()


def _signup_click_stream(spark):
    """sf0.001 events plus a far-future signup and click of a sentinel user:
    both filtered sides see it, so both watermarks pass every real row."""
    d = tempfile.mkdtemp(prefix="tidepool-ev-")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.write.mode("overwrite").parquet(d)
    far = dt.datetime(2100, 1, 1)
    spark.createDataFrame([(-1, far, -1, "signup", 0.0, ""), (-2, far, -1, "click", 0.0, "")], ev.schema) \
        .write.mode("append").parquet(d)
    return spark.readStream.schema(ev.schema).parquet(d), ev


def test_stream_join_and_expired_equal_batch(spark):
    from tidepool.streaming.joins import stream_join_expired, stream_single_join
    stream, ev = _signup_click_stream(spark)
    st = event_time(stream)
    a = st.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("a_ts"))
    b = st.filter("event_type = 'click'").select("user_id", F.col("ts").alias("b_ts"))
    run_available(stream_single_join(a, b, ["user_id"], "a_ts", "b_ts", 1800, "1 hour"), "sj_stream",
                  checkpoint=_ckpt())
    run_available(stream_join_expired(a, b, ["user_id"], "a_ts", "b_ts", 1800, "1 hour"), "exp_stream",
                  checkpoint=_ckpt())
    ab = ev.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("a_ts"))
    bb = ev.filter("event_type = 'click'").select("user_id", F.col("ts").alias("b_ts"))
    got_j = spark.sql("SELECT user_id, CAST(a_ts AS timestamp_ntz) a_ts, CAST(b_ts AS timestamp_ntz) b_ts "
                      "FROM sj_stream WHERE user_id >= 0")
    exp_j = J.interval_join(ab, bb, ["user_id"], "a_ts", "b_ts", 1800).select("user_id", "a_ts", "b_ts")
    assert _as_rows(got_j) == _as_rows(exp_j)
    got_e = spark.sql("SELECT user_id, CAST(a_ts AS timestamp_ntz) AS ts FROM exp_stream WHERE user_id >= 0")
    exp_e = J.join_expired(ab, bb, ["user_id"], "a_ts", "b_ts", 1800, names=("a", "b")) \
        .filter("side = 'a'").select("user_id", "ts")
    assert _as_rows(got_e) == _as_rows(exp_e) and got_e.count() > 0


def test_stream_uniqueness_guard(spark):
    from tidepool.streaming.joins import guard_unique, unique_within_watermark
    seen = []
    body = guard_unique(["id"], lambda df, i: seen.append(df.count()))
    body(spark.createDataFrame([(1, "a"), (2, "b")], "id long, word string"), 0)
    assert seen == [2]
    with pytest.raises(ValueError, match="more than once on one side"):
        body(spark.createDataFrame([(1, "a"), (1, "b")], "id long, word string"), 1)
    rows = [(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 1, 0, 1)), (2, dt.datetime(2024, 1, 1))]
    d = _feeds([rows], pa.schema([("id", pa.int64()), ("ts", pa.timestamp("us"))]))
    s = event_time(feed_stream(spark, d, "id long, ts timestamp_ntz"))
    run_available(unique_within_watermark(s, ["id"], "ts", "1 hour"), "uniq_stream", checkpoint=_ckpt())
    assert sorted(r[0] for r in spark.sql("SELECT id FROM uniq_stream").collect()) == [1, 2]


def test_running_count_stream_with_ttl(spark):
    batches = [[(i, f"w{i % 2}") for i in range(b * 4, b * 4 + 4)] for b in range(2)]
    d = _feeds(batches, WORDS)
    s = feed_stream(spark, d, "id long, word string")
    q = (running_count_stream(s, "word", ["id"], ttl_ms=3_600_000).writeStream.format("memory")
         .queryName("rc_ttl").option("checkpointLocation", _ckpt()).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 90
        while time.time() < deadline and spark.sql("SELECT count(*) FROM rc_ttl").collect()[0][0] < 8:
            time.sleep(0.5)
    finally:
        q.stop()
    got = {r["id"]: r["count"] for r in spark.sql("SELECT * FROM rc_ttl").collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 2, 4: 3, 5: 3, 6: 4, 7: 4}


def test_merge_two_streams(spark):
    from tidepool.operators.distribution import merge_streams
    d1 = _feeds([[(1, "a b")]], pa.schema([("id", pa.int64()), ("sentence", pa.string())]))
    d2 = _feeds([[(2, "c")]], pa.schema([("id", pa.int64()), ("word", pa.string())]))
    s1 = feed_stream(spark, d1, "id long, sentence string").select("sentence")
    s2 = feed_stream(spark, d2, "id long, word string").select("word")
    run_available(merge_streams([s1, s2], ["sentence"]), "merged_stream", checkpoint=_ckpt())
    assert sorted(r[0] for r in spark.sql("SELECT sentence FROM merged_stream").collect()) == ["a b", "c"]


def test_choice_stream_from_rate_source(spark):
    from tidepool.sources.choice import RANDOM_SENTENCES, choice_stream
    s = choice_stream(spark, RANDOM_SENTENCES, rows_per_second=50)
    q = (s.writeStream.format("memory").queryName("rate_choice").option("checkpointLocation", _ckpt())
         .trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.sql("SELECT count(*) FROM rate_choice").collect()[0][0] < 20:
            time.sleep(0.5)
    finally:
        q.stop()
    rows = spark.sql("SELECT value, sentence FROM rate_choice").collect()
    assert len(rows) >= 20 and all(r["sentence"] in RANDOM_SENTENCES for r in rows)


def test_request_stream_against_latest_state(spark):
    """J4 with streaming requests: a stream-static join on the newest version
    of the word-count state table."""
    from tidepool.operators import generators as G
    from tidepool.operators.reach import lookup_sum
    root = tempfile.mkdtemp(prefix="tidepool-state-")
    store = VersionedStore(spark, f"{root}/wc", "key string, count long")
    store.write(spark.createDataFrame([("the", 5), ("jumped", 1)], "key string, count long"), 0)
    counts = store.latest().withColumnRenamed("key", "word")
    d = _feeds([[(0, "cat the dog jumped"), (1, "zzz")]], pa.schema([("request_id", pa.int64()), ("args", pa.string())]))
    req = feed_stream(spark, d, "request_id long, args string")
    words = G.tokens(req, "args", "java", keep=("request_id",))
    found, _ = lookup_sum(words, counts)
    run_available(found, "found_stream", checkpoint=_ckpt())
    got = sorted((r["request_id"], r["word"], r["count"]) for r in spark.sql("SELECT * FROM found_stream").collect())
    assert got == [(0, "jumped", 1), (0, "the", 5)]


def test_slot_counts_stream_equals_batch(spark):
    stream, ev = _events_with_sentinel(spark)
    s = W.slot_counts(event_time(stream), "user_id", "ts", 86400, watermark="1 hour")
    run_available(s, "slots_stream", checkpoint=_ckpt())
    got = spark.sql("SELECT obj, CAST(slot_start AS timestamp_ntz) AS slot_start, count FROM slots_stream "
                    "WHERE obj >= 0")
    assert _as_rows(got) == _as_rows(W.slot_counts(ev, "user_id", "ts", 86400))


def test_request_tables_and_results(spark):
    from tidepool.sources.requests import requests_from, requests_stream, write_results
    root = tempfile.mkdtemp(prefix="tidepool-req-")
    cu = spark.createDataFrame([(7, "aaa"), (8, "bbb")], "c_custkey long, c_name string")
    req = requests_from(cu, "c_custkey", "c_name")
    res = req.select("request_id", F.concat("args", F.lit("!!!")).alias("result"))
    write_results(res, f"{root}/out")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").collect()) == [(7, "aaa!!!"), (8, "bbb!!!")]
    req.write.parquet(f"{root}/in")
    run_available(requests_stream(spark, f"{root}/in").select("request_id"), "req_stream", checkpoint=_ckpt())
    assert sorted(r[0] for r in spark.sql("SELECT request_id FROM req_stream").collect()) == [7, 8]


def test_keyed_changelog_in_state_store(spark):
    from tidepool.streaming.stateful import keyed_changelog_stream
    root = tempfile.mkdtemp(prefix="tidepool-kc-")
    out = BatchOutput(spark, root)
    d = _feeds(_transactional_batches(), WORDS)
    s = keyed_changelog_stream(feed_stream(spark, d, "id long, word string"), "word")
    run_foreach_batch(s, "kc_stream", lambda df, i: out.write(df, i), checkpoint=_ckpt())
    got = {(r["batch_id"], r["word"]): (r["prev_count"], r["count"]) for r in out.read().collect()}
    assert got == {
        (0, "apple"): (None, 1), (0, "cat"): (None, 5), (0, "chicken"): (None, 1), (0, "dog"): (None, 2),
        (1, "apple"): (1, 2), (1, "banana"): (None, 1), (1, "cat"): (5, 8), (1, "dog"): (2, 4),
        (2, "dog"): (4, 7),
    }


def test_sliding_direct_stream_equals_batch(spark):
    stream, ev = _events_with_sentinel(spark)
    s = W.sliding_count(event_time(stream), "event_type", "ts", 4 * 3600, 3600, watermark="1 hour")
    run_available(s, "w4_stream", checkpoint=_ckpt())
    got = spark.sql("SELECT CAST(window_start AS timestamp_ntz) window_start, CAST(window_end AS timestamp_ntz) "
                    "window_end, obj, count FROM w4_stream WHERE obj <> '__sentinel__'")
    assert _as_rows(got) == _as_rows(W.sliding_count(ev, "event_type", "ts", 4 * 3600, 3600))


def test_console_sink_runs(spark, capfd):
    d = _feeds([[(1, "hello")]], WORDS)
    q = run_available(feed_stream(spark, d, "id long, word string"), "console_stream", sink="console",
                      checkpoint=_ckpt())
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] == 1
