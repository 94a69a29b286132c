"""Tracker, persistent ranking and replayable source as streams, against their batch forms."""

import datetime as dt
import itertools
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.test_tracker import GOLDENS, T0
from tidepool.operators import ranking as R
from tidepool.operators import windows as W
from tidepool.operators.ordered import quantile_chunk
from tidepool.plans.catalog import QUERIES
from tidepool.sources.batches import with_batch_id, with_partitioned_batch_id
from tidepool.streaming.rankings import BUCKET_TOPS, persistent_ranking_job
from tidepool.streaming.replay import Replay, run_replay, write_replay
from tidepool.streaming.runner import run_available
from tidepool.streaming.tracker import tracker_stream
from tidepool.streaming.versioned import BatchOutput, VersionedStore, global_counter

SF = "/root/testdata/sf0.001"
START = T0.strftime("%Y-%m-%d %H:%M:%S")
MARKS = "key string, seq long, ts timestamp"


def fresh(scratch):
    return f"{scratch}/{uuid.uuid4().hex}"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def run_marks(spark, root, batches, n, watermark="0 seconds", **settings):
    """Each list a micro-batch of its own; all rows given."""
    for rows in batches:
        spark.createDataFrame(rows, MARKS).coalesce(1).write.mode("append").parquet(f"{root}/in")
        s = spark.readStream.schema(MARKS).parquet(f"{root}/in")
        run_available(tracker_stream(s, "key", "ts", "seq", n, START, watermark, **settings), f"tr_{uuid.uuid4().hex}", sink="parquet",
                      path=f"{root}/out", checkpoint=f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


def test_all_goldens_over_micro_batches(spark, scratch):
    """One key per golden with its own n would need as many streams: goldens of one n share one."""
    for n, group in itertools.groupby(sorted(GOLDENS, key=lambda g: g[0]), key=lambda g: g[0]):
        goldens = list(group)
        marks = [[(f"k{g}", i, at(t)) for i, t in enumerate(itertools.accumulate(adv))] for g, (_, adv, _) in enumerate(goldens)]
        batches = [sorted((r for m in marks for r in m if lo <= r[1] < hi), key=str) for lo, hi in ((0, 1), (1, 4), (4, 9))]
        got = run_marks(spark, fresh(scratch), [b for b in batches if b], n, watermark="1 hour").collect()
        for g, (_, _, expected) in enumerate(goldens):
            mine = sorted((r["seq"], r["seconds_since_oldest"]) for r in got if r["key"] == f"k{g}" and r["kind"] == "mark")
            assert [a for _, a in mine] == expected, (n, g)


def test_events_equal_batch_and_ticks(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet").select(F.concat(F.lit("u"), F.col("user_id") % 7).alias("key"), F.col("event_id").alias("seq"), "ts")
    rows = [tuple(r) for r in ev.orderBy("ts", "seq").collect()]
    batches = [rows[len(rows) * k // 3:len(rows) * (k + 1) // 3] for k in range(3)]
    start = min(r[2] for r in rows).replace(hour=0, minute=0, second=0, microsecond=0)
    root, tick = fresh(scratch), 6 * 3600
    global START
    old, START = START, start.strftime("%Y-%m-%d %H:%M:%S")
    try:
        got = run_marks(spark, root, batches, 3, tick_seconds=tick).collect()
    finally:
        START = old
    expected = W.nth_last_modified(ev, "key", "ts", "seq", 3, start_ts=F.lit(start), chunk=quantile_chunk(ev, "ts"))
    assert sorted((r["seq"], r["seconds_since_oldest"]) for r in got if r["kind"] == "mark") == sorted(
        (r["seq"], r["seconds_since_oldest"]) for r in expected.collect())
    marks = {}
    for k, _, t in rows:
        marks.setdefault(k, []).append(t)
    ticks = [r for r in got if r["kind"] == "tick"]
    assert len(ticks) > 50 and len({(r["key"], r["ts"]) for r in ticks}) == len(ticks)
    for r in ticks:
        known = [t for t in sorted(marks[r["key"]]) if t <= r["ts"]]
        oldest = known[-3] if len(known) >= 3 else start
        assert r["seconds_since_oldest"] == (r["ts"] - oldest) // dt.timedelta(seconds=1)
        assert (r["ts"] - start) % dt.timedelta(seconds=tick) == dt.timedelta(0)


def test_idle_keys_are_forgotten(spark, scratch):
    """Expired keys equal a batch anti join: no mark in the time after their last one."""
    batches = [[("a", 1, at(0)), ("b", 2, at(5))], [("b", 3, at(30)), ("c", 4, at(31))], [("b", 5, at(55))], [("z", 6, at(200))], [("z", 7, at(210))]]
    got = run_marks(spark, fresh(scratch), batches, 2, expire_seconds=30).where("kind = 'idle'").collect()
    rows = [r for b in batches for r in b]
    lonely = {(k, t + dt.timedelta(seconds=30)) for k, _, t in rows
              if t + dt.timedelta(seconds=30) < at(200) and not any(j == k and t < u <= t + dt.timedelta(seconds=30) for j, _, u in rows)}
    assert {(r["key"], r["ts"]) for r in got} == lonely and len(got) == len(lonely) == 3
    with pytest.raises(ValueError):
        run_marks(spark, fresh(scratch), [[("a", 1, at(0))]], 2, expire_seconds=0)


COUNTS = "obj string, count long, seq long"


@pytest.mark.parametrize("buckets", [1, 4])
def test_ranking_lives_between_ticks(spark, scratch, buckets):
    """Counts rise and fall over ticks; each tick's ranking equals merge_rankings over all counts so far."""
    rng, root, n = random.Random(buckets), fresh(scratch), 4
    tops, out = VersionedStore(spark, f"{root}/tops", BUCKET_TOPS), BatchOutput(spark, f"{root}/out")
    seen, seq = [], itertools.count()
    for tick in range(5):
        rows = [(f"o{rng.randrange(15)}", rng.randrange(-5, 40), next(seq)) for _ in range(rng.randrange(1, 25))]
        rows += [("hot", rng.randrange(60), next(seq)) for _ in range(20)] if tick % 2 else []
        if tick == 3:
            rows += [("late", 50, 10_000), ("late", 3, 9_000), (None, 99, next(seq)), ("none", None, next(seq))]
        seen += [r for r in rows if r[0] is not None and r[1] is not None]
        rng.shuffle(rows)
        spark.createDataFrame(rows, COUNTS).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(COUNTS).parquet(f"{root}/in")
        persistent_ranking_job(stream, tops, out, f"rank_{uuid.uuid4().hex}", "obj", "count", "seq", n, buckets, checkpoint=f"{root}/checkpoint")
        expected = R.merge_rankings([spark.createDataFrame(seen, COUNTS)], "obj", "count", "seq", n)
        got = out.read().where(F.col("batch_id") == tick)
        assert sorted((r["rank"], r["obj"], r["count"]) for r in got.collect()) == sorted((r["rank"], r["obj"], r["count"]) for r in expected.collect())


def test_a_replayed_tick_changes_nothing(spark, scratch):
    from tidepool.streaming.rankings import total_ranking

    root = fresh(scratch)
    tops, out = VersionedStore(spark, f"{root}/tops", BUCKET_TOPS), BatchOutput(spark, f"{root}/out")
    body = total_ranking(tops, out, 2)
    one = spark.createDataFrame([(0, "a", 5), (1, "b", 4)], BUCKET_TOPS)
    two = spark.createDataFrame([(0, "a", 1), (0, "c", 1)], BUCKET_TOPS)
    body(one, 0)
    for _ in range(2):
        body(two, 1)
    body(two.limit(0), 2)
    got = sorted((r["batch_id"], r["rank"], r["obj"], r["count"]) for r in out.read().collect())
    assert got == [(0, 1, "a", 5), (0, 2, "b", 4), (1, 1, "b", 4), (1, 2, "a", 1), (2, 1, "b", 4), (2, 2, "a", 1)]


def test_replay_equals_the_batch_source(spark, scratch):
    """Batch ids and rows of the registered source, a take of every partition a batch."""
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", (F.col("user_id") % 3).alias("part"))
    path = fresh(scratch)
    write_replay(ev, path, ["event_id"], 100, quantile_chunk(ev, "event_id"), part="part", group=2)
    replay, got = Replay(spark, path, group=2), []
    run_replay(replay, f"rp_{uuid.uuid4().hex}", lambda rows, b: got.extend((b, r["part"], r["event_id"], r["batch_id"]) for r in rows.collect()),
               checkpoint=fresh(scratch))
    expected = [(r["batch_id"], r["part"], r["event_id"], r["batch_id"]) for r in QUERIES["src_partitioned_batches"](spark, SF).collect()]
    assert sorted(got) == sorted(expected) and replay.batches > 2
    plan = replay.batch(1)._jdf.queryExecution().executedPlan().toString()
    assert "batch_group" in plan.split("PartitionFilters")[1].split("]")[0] and "EqualTo(batch_id,1)" in plan


def test_restart_reads_the_same_batch(spark, scratch):
    """The body dies in batch 1 after its output was written; a new query on the checkpoint repeats it, then cycles."""
    words = spark.createDataFrame([(i, i % 3, f"w{i % 4}") for i in range(20)], "id long, part long, word string")
    path, checkpoint, root = fresh(scratch), fresh(scratch), fresh(scratch)
    write_replay(words, path, ["id"], 3, quantile_chunk(words, "id"), part="part")
    store, out = VersionedStore(spark, f"{root}/state", "count long"), BatchOutput(spark, f"{root}/out")
    body, seen = global_counter(store, out), []

    def dies(rows, b):
        body(rows, b)
        seen.append((b, sorted(r["id"] for r in rows.collect())))
        if b == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run_replay(Replay(spark, path), f"rp_{uuid.uuid4().hex}", dies, cycles=2, checkpoint=checkpoint)

    def lives(rows, b):
        body(rows, b)
        seen.append((b, sorted(r["id"] for r in rows.collect())))

    run_replay(Replay(spark, path), f"rp_{uuid.uuid4().hex}", lives, cycles=2, checkpoint=checkpoint)
    assert [b for b, _ in seen] == [0, 1, 1, 2, 3, 4, 5] and seen[1] == seen[2]
    assert [r for _, r in seen[4:]] == [r for _, r in (seen[0], seen[1], seen[3])]  # the second cycle
    assert sorted((r["batch_id"], r["count"], r["global_count"]) for r in out.read().collect()) == [
        (0, 9, 9), (1, 9, 18), (2, 2, 20), (3, 9, 29), (4, 9, 38), (5, 2, 40)]


def test_fixed_batches_and_guards(spark, scratch):
    words = spark.createDataFrame([(i,) for i in range(10)], "id long")
    path = fresh(scratch)
    write_replay(words, path, ["id"], 4, quantile_chunk(words, "id"))
    got = {}
    run_replay(Replay(spark, path), f"rp_{uuid.uuid4().hex}", lambda rows, b: got.update({b: sorted(r["id"] for r in rows.collect())}), checkpoint=fresh(scratch))
    assert got == {0: [0, 1, 2, 3], 1: [4, 5, 6, 7], 2: [8, 9]}
    assert with_batch_id(words, ["id"], 4, quantile_chunk(words, "id")).count() == 10
    assert with_partitioned_batch_id(words.withColumn("p", F.lit(0)), "p", ["id"], 4, quantile_chunk(words, "id")).count() == 10
    with pytest.raises(ValueError):
        run_replay(Replay(spark, path), "x", print, cycles=0)
