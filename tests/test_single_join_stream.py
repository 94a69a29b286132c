"""Single join of three streams: joined and expired rows equal the batch form, the time-out and double arrival, replay."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidepool.operators import joins as J
from tidepool.streaming.runner import run_available, run_foreach_batch
from tidepool.streaming.single_join import joined_and_expired, single_join_stream
from tidepool.streaming.versioned import BatchOutput

T0 = dt.datetime(2024, 1, 1)
NAMES = {"gender": "g string", "age": "a long", "city": "c string"}
SCHEMAS = {n: f"id long, ts timestamp, {f}" for n, f in NAMES.items()}
END = 10 ** 6  # a row this late moves the watermark past everything (tests only)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


class Feeds:
    """Three folders, one file of each per micro-batch."""

    def __init__(self, spark, scratch):
        self.spark, self.root, self.n = spark, f"{scratch}/{uuid.uuid4().hex}", 0
        self.checkpoint = f"{self.root}/checkpoint"

    def add(self, **rows):
        for name, schema in SCHEMAS.items():
            data = [(k, at(t), v) for k, t, v in rows.get(name, [])]
            folder = f"{self.root}/{name}"
            self.spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
        self.n += 1

    def sides(self):
        return {n: self.spark.readStream.schema(s).parquet(f"{self.root}/{n}") for n, s in SCHEMAS.items()}

    def stream(self, timeout=10, watermark="0 seconds", **settings):
        return single_join_stream(self.sides(), ["id", "g", "a", "c"], "ts", timeout, watermark, keys=["id"], **settings)

    def run(self, **settings):
        """Process what has come; all rows given so far."""
        out = f"{self.root}/out"
        run_available(self.stream(**settings), f"sj_{uuid.uuid4().hex}", sink="parquet", path=out, checkpoint=self.checkpoint)
        rows = self.spark.read.parquet(out).where("id is null or id < 1000").collect() if os.path.isdir(out) else []
        return sorted((r["status"], r["side"] or "", -1 if r["id"] is None else r["id"], (r["ts"] - T0).total_seconds(), r["g"], r["a"], r["c"]) for r in rows)

    def flush(self, **settings):
        """Two sparse micro-batches: the first moves the watermark, the second sees it."""
        for k in (0, 1):
            self.add(gender=[(1000 + k, END + k * END, "end")])
            got = self.run(**settings)
        return got


def test_any_order_over_micro_batches(spark, scratch):
    f = Feeds(spark, scratch)
    f.add(gender=[(1, 0, "m"), (2, 1, "f"), (None, 2, "n")], age=[(1, 3, 20)], city=[(9, 2, "x")])
    assert f.run() == []
    f.add(age=[(2, 5, 30), (None, 4, 40)], city=[(1, 10, "rome"), (2, 11, "oslo"), (None, 5, "null")])
    joined = f.run()
    assert joined == [("joined", "", -1, 5.0, "n", 40, "null"), ("joined", "", 1, 10.0, "m", 20, "rome"), ("joined", "", 2, 11.0, "f", 30, "oslo")]
    assert f.flush() == sorted([*joined, ("expired", "city", 9, 2.0, None, None, "x")])


def test_expired_rows_of_every_side(spark, scratch):
    f = Feeds(spark, scratch)
    # key 1: the last side comes one second too late; key 2: exactly in time; key 3: one side only
    f.add(gender=[(1, 0, "m"), (2, 0, "f")], age=[(1, 4, 20), (2, 4, 30)], city=[(1, 11, "rome"), (2, 10, "oslo"), (3, 1, "bonn")])
    got = f.flush()
    assert got == sorted([("joined", "", 2, 10.0, "f", 30, "oslo"), ("expired", "gender", 1, 0.0, "m", None, None),
                          ("expired", "age", 1, 4.0, None, 20, None), ("expired", "city", 1, 11.0, None, None, "rome"),
                          ("expired", "city", 3, 1.0, None, None, "bonn")])


def test_equals_batch(spark, scratch):
    """Random arrival over four micro-batches against the batch operators on the same rows."""
    rng = random.Random(4)
    rows = {n: [] for n in NAMES}
    for k in range(60):
        base = rng.randrange(0, 100)
        for n in NAMES:
            if rng.random() < 0.85:
                rows[n].append((k, base + rng.randrange(0, 14), rng.randrange(5) if n == "age" else f"{n}{k}"))
    f = Feeds(spark, scratch)
    parts = {n: [[] for _ in range(4)] for n in NAMES}
    for n, rs in rows.items():
        for r in rs:
            parts[n][rng.randrange(4)].append(r)
    for b in range(4):  # the watermark waits long enough for every arrival
        f.add(**{n: parts[n][b] for n in NAMES})
        f.run(watermark="200 seconds")
    got = f.flush(watermark="200 seconds")
    frames = {n: spark.createDataFrame([(k, at(t), v) for k, t, v in rows[n]], SCHEMAS[n]) for n in NAMES}
    outcome = J.single_join_outcome(frames, ["id"], "ts", 10).collect()
    assert sorted((r["status"], r["side"] or "", r["id"], (r["ts"] - T0).total_seconds()) for r in outcome) == [r[:4] for r in got]
    whole = J.single_join([x.withColumnRenamed("ts", f"ts{i}") for i, x in enumerate(frames.values())], ["id", "g", "a", "c", "ts0", "ts1", "ts2"], keys=["id"])
    near = whole.where(F.expr("greatest(ts0, ts1, ts2) - least(ts0, ts1, ts2) <= interval 10 seconds"))
    assert sorted((r["id"], r["g"], r["a"], r["c"]) for r in near.collect()) == sorted((r[2], *r[4:]) for r in got if r[0] == "joined")
    assert {r[0] for r in got} == {"joined", "expired"}


def test_same_side_twice(spark, scratch):
    f = Feeds(spark, scratch)
    f.add(gender=[(1, 0, "m")])
    f.run()
    f.add(gender=[(1, 3, "f")])  # in another micro-batch, still pending
    with pytest.raises(StreamingQueryException, match=J.SAME_SIDE_TWICE):
        f.run()
    g = Feeds(spark, scratch)
    g.add(gender=[(1, 0, "m"), (1, 2, "f")], age=[(1, 5, 7)], city=[(1, 6, "x")])
    assert g.run(on_duplicate="ignore") == [("joined", "", 1, 6.0, "m", 7, "x")]
    # a completed or expired key may come again
    g.add(gender=[(1, 7, "again")])
    assert len(g.run(on_duplicate="ignore")) == 1
    assert ("expired", "gender", 1, 7.0, "again", None, None) in g.flush(on_duplicate="ignore")


def test_replay_of_a_failed_batch(spark, scratch):
    """The sink fails after the processor ran: the micro-batch runs again from the same pending rows."""
    f = Feeds(spark, scratch)
    joined, expired = BatchOutput(spark, f"{f.root}/joined"), BatchOutput(spark, f"{f.root}/expired")
    body, fail = joined_and_expired(joined, expired), [True]

    def once(batch, batch_id):
        body(batch, batch_id)
        if fail and not batch.isEmpty():
            fail.pop()
            raise RuntimeError("lost")

    def run(b):
        run_foreach_batch(f.stream(), f"sj_{uuid.uuid4().hex}", b, checkpoint=f.checkpoint)

    f.add(gender=[(1, 0, "m"), (2, 0, "f")], age=[(1, 1, 20)])
    run(once)
    f.add(city=[(1, 2, "rome")], age=[(2, 2, 30)])
    with pytest.raises(StreamingQueryException):
        run(once)
    assert not fail
    run(once)
    assert [(r["id"], r["g"], r["a"], r["c"]) for r in joined.read().collect()] == [(1, "m", 20, "rome")]
    f.add(city=[(2, 3, "oslo")])
    run(body)
    assert sorted((r["id"], r["c"]) for r in joined.read().collect()) == [(1, "rome"), (2, "oslo")]


def test_guards(spark, scratch):
    f = Feeds(spark, scratch)
    f.add()
    with pytest.raises(ValueError):
        f.stream(timeout=-1)
    with pytest.raises(ValueError):
        f.stream(on_duplicate="maybe")
    with pytest.raises(ValueError, match=J.MISSING_OUTFIELDS):
        single_join_stream(f.sides(), ["id", "nowhere"], "ts", 10, "0 seconds")
