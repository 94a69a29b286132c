"""Time since the N-th last mark on a stream (W5), read at marks and at ticks.

Each key keeps its last marks as a ``ListState`` of event times.  A mark's row
gives its age at once.  At ticks, every ``tick_seconds`` of event time from the
start, a timer reads the key's ring: it fires when the watermark has passed the
tick, so all marks up to it are in and marks after it, which may be in too, are
not counted.  The list holds the ``n`` marks up to the last tick read and those
after it; without ticks just ``n``.

A key without a mark for ``expire_seconds`` is reported and forgotten at a
timer (T5 in event time), so idle keys do not hold state for ever.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidepool.operators.guards import require_tracked
from tidepool.streaming.stateful import use_rocksdb

MARK, TICK, IDLE = "mark", "tick", "idle"
_US, _MARK = "_tp_us", "_tp_ts"


class Tracker(StatefulProcessor):
    def __init__(self, columns: list[str], key: str, n: int, start_us: int, tick_us: int | None, expire_us: int | None):
        self.columns, self.key, self.n, self.start = columns, key, n, start_us
        self.tick, self.expire = tick_us, expire_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        long = StructType([StructField("us", LongType())])
        self.marks = handle.getListState("marks", long)
        self.read = handle.getValueState("read", long)  # the last tick that was read

    def _row(self, key, kind: str, at: int, tiebreak, age: int) -> Row:
        return Row(self.key, "kind", "us", "tiebreak", "seconds_since_oldest")(key[0], kind, at, tiebreak, age)

    def _age(self, marks: list[int], at: int) -> int:
        """Whole seconds from the oldest of the last n marks up to ``at`` (the start where there are fewer) to ``at``."""
        i = bisect.bisect_right(marks, at) - self.n
        oldest = marks[i] if i >= 0 else self.start
        return max(at - oldest, 0) // 1_000_000

    def _arm(self, marks: list[int], read: int) -> None:
        """The next timer: one past the next tick, or past the time at which the key has been idle for too long."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = [read + self.tick] if self.tick else []
        if self.expire and marks:
            due.append(marks[-1] + self.expire)
        if due:
            self.handle.registerTimer(min(due) // 1000 + 1)

    def _keep(self, marks: list[int], read: int) -> None:
        """Only the last n marks up to the last tick read can still be asked for, and those after it."""
        upto = bisect.bisect_right(marks, read) if self.tick else len(marks)
        marks = marks[max(upto - self.n, 0):]
        self.marks.put([(m,) for m in marks])
        self.read.update((read,))
        self._arm(marks, read)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, tie = self.columns.index(_US), self.columns.index("_tp_tiebreak")
        marks = sorted(m[0] for m in self.marks.get()) if self.marks.exists() else []
        come = sorted((r[at], r[tie]) for r in rows)
        if not come:
            return
        read = self.read.get()[0] if self.read.exists() else self._tick_before(come[0][0])
        for us, tiebreak in come:
            bisect.insort(marks, us)
            yield self._row(key, MARK, us, tiebreak, self._age(marks, us))
            if not self.tick and len(marks) > self.n:
                del marks[0]
        self._keep(marks, read)

    def _tick_before(self, us: int) -> int:
        """The last tick before a key's first mark: its first reading is at the tick from the mark on."""
        return self.start + ((us - self.start - 1) // self.tick) * self.tick if self.tick else self.start

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        marks, read = sorted(m[0] for m in self.marks.get()), self.read.get()[0]
        passed = timerValues.getCurrentWatermarkInMs() * 1000 - 1
        ends = marks[-1] + self.expire if self.expire else None
        while self.tick and read + self.tick <= passed and (ends is None or read + self.tick <= ends):
            read += self.tick
            yield self._row(key, TICK, read, None, self._age(marks, read))
        if ends is not None and ends <= passed:
            yield self._row(key, IDLE, ends, None, self._age(marks, ends))
            self.marks.clear()
            self.read.clear()
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
        else:
            self._keep(marks, read)

    def close(self) -> None:
        pass


def tracker_stream(df: DataFrame, key: str, ts: str, tiebreak: str, n: int, start: str, watermark: str, tick_seconds: int | None = None,
                   expire_seconds: int | None = None) -> DataFrame:
    """Rows ``(key, kind, ts, tiebreak, seconds_since_oldest)``: one of kind
    ``mark`` for every row of ``df``, one of kind ``tick`` for every known key
    and tick, and one of kind ``idle`` when a key is forgotten.

    ``start`` is the time the tracking starts (a timestamp literal, as the
    stream's rows have it); the ring is pre-filled with it.  Marks of a
    micro-batch are taken in order of (ts, tiebreak); their two numbers a row
    are sorted in the key's task.  A mark that comes late but ahead of the
    watermark is put in its place and changes later readings only.  Rows without
    a time are left out."""
    require_tracked(n)
    for seconds in (tick_seconds, expire_seconds):
        if seconds is not None and seconds < 1:
            raise ValueError("ticks and expiry are at least a second")
    spark = df.sparkSession
    use_rocksdb(spark)
    start_us = spark.range(1).select(F.unix_micros(F.to_timestamp(F.lit(start)))).first()[0]
    d = df.where(F.col(ts).isNotNull()).select(key, F.col(ts).cast("timestamp").alias(_MARK), F.col(tiebreak).cast("long").alias("_tp_tiebreak"))
    d = d.withColumn(_US, F.unix_micros(_MARK))
    us = lambda s: None if s is None else s * 1_000_000
    out = StructType([df.schema[key], StructField("kind", StringType()), StructField("us", LongType()), StructField("tiebreak", LongType()),
                      StructField("seconds_since_oldest", LongType())])
    found = (d.withWatermark(_MARK, watermark).groupBy(key)
             .transformWithState(Tracker(d.columns, key, n, start_us, us(tick_seconds), us(expire_seconds)), out, "Append", "EventTime"))
    return found.select(key, "kind", F.timestamp_micros("us").alias(ts), F.col("tiebreak").alias(tiebreak), F.col("seconds_since_oldest").cast("int").alias("seconds_since_oldest"))
