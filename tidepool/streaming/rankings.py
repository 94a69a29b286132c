"""A ranking that persists between the ticks of a stream.

Two levels.  Objects are hashed to buckets; a bucket's state is a map object ->
latest (count, seq) and an ordered list of its N best.  An upsert touches the
list only: the bucket is scanned again just when an object of a full list got
worse, because one outside may then be better (so the ranking stays exact when
counts fall).  Each micro-batch - a tick - emits the lists of the buckets it
touched; the second level keeps the newest list of every bucket, at most
buckets * N rows, and writes the total ranking of the tick.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidepool.operators.guards import require_top_n
from tidepool.operators.ranking import rank_top
from tidepool.streaming.runner import run_foreach_batch
from tidepool.streaming.stateful import use_rocksdb
from tidepool.streaming.versioned import BatchOutput, VersionedStore

BUCKET_TOPS = "bucket int, obj string, count long"
_BUCKET = "_tp_bucket"


def _best(items, n: int) -> list[tuple[str, int]]:
    """The n items (obj, count) of the largest counts, ties by object."""
    return heapq.nsmallest(n, items, key=lambda x: (-x[1], x[0]))


class BucketRanking(StatefulProcessor):
    def __init__(self, columns: list[str], n: int):
        self.columns, self.n = columns, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        obj, count, seq = StructField("obj", StringType()), StructField("count", LongType()), StructField("seq", LongType())
        self.latest = handle.getMapState("latest", StructType([obj]), StructType([count, seq]))
        self.top = handle.getListState("top", StructType([obj, count]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at = [self.columns.index(c) for c in ("obj", "count", "seq")]
        before = {o: c for o, c in self.top.get()} if self.top.exists() else {}
        top, worse, full = dict(before), False, len(before) >= self.n
        for r in rows:
            obj, count, seq = (r[i] for i in at)
            if self.latest.containsKey((obj,)):
                old_count, old_seq = self.latest.getValue((obj,))
                if old_seq > seq:
                    continue  # a later count is known
                worse = worse or (full and obj in before and count < before[obj])
            self.latest.updateValue((obj,), (count, seq))
            top[obj] = count
            if len(top) > 4 * self.n and not worse:
                top = dict(_best(top.items(), self.n))
        found = _best(((k[0], v[0]) for k, v in self.latest.iterator()) if worse else top.items(), self.n)
        self.top.put(found)
        for obj, count in found:
            yield Row("bucket", "obj", "count")(key[0], obj, count)

    def close(self) -> None:
        pass


def bucket_rankings_stream(counts: DataFrame, obj: str, count: str, seq: str, n: int = 10, buckets: int = 16) -> DataFrame:
    """``(bucket, obj, count)``: per micro-batch the whole N best of every
    bucket that it touched.  ``counts`` holds updates in any order; of an object
    the one of the highest ``seq`` counts (the larger count of equal ones).  The
    micro-batch is cut to one row per object by a partial aggregate, so an object that
    holds a third of it is no hot key.  Rows without an object or a count are left out."""
    require_top_n(n)
    if buckets < 1:
        raise ValueError("at least one bucket is needed")
    use_rocksdb(counts.sparkSession)
    d = counts.where(F.col(obj).isNotNull() & F.col(count).isNotNull()).select(
        F.pmod(F.hash(F.col(obj)), F.lit(buckets)).alias(_BUCKET), F.col(obj).cast("string").alias("obj"),
        F.col(count).cast("long").alias("count"), F.coalesce(F.col(seq).cast("long"), F.lit(0)).alias("seq"))
    schema = StructType([StructField("bucket", IntegerType()), StructField("obj", StringType()), StructField("count", LongType())])
    return d.groupBy(_BUCKET).transformWithState(BucketRanking(d.columns, n), schema, "Append", "None")


def total_ranking(tops: VersionedStore, output: BatchOutput, n: int = 10, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body of the second level: a touched bucket's list
    replaces its earlier one, and the ranking of all lists is written per tick,
    also when nothing changed.  A replayed tick starts from the tick before."""

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        old = tops.read_before(batch_id).join(batch.select("bucket").distinct(), "bucket", "left_anti")
        tops.write(old.unionByName(batch), batch_id)
        output.write(rank_top(tops.read(batch_id).drop("bucket"), "obj", "count", n), batch_id)
        batch.unpersist()
        tops.prune(keep)

    return body


def persistent_ranking_job(counts: DataFrame, tops: VersionedStore, output: BatchOutput, name: str, obj: str, count: str, seq: str, n: int = 10,
                           buckets: int = 16, processing_time: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """R6 as the reference runs it: the ranking lives on between ticks and is written at each one."""
    stream = bucket_rankings_stream(counts, obj, count, seq, n, buckets)
    return run_foreach_batch(stream, name, total_ranking(tops, output, n), "append", checkpoint, processing_time)
