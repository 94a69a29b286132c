"""A replayable source with a take per partition or in fixed batches (S5, S6), as a stream.

``write_replay`` lays a table out by batch once: batch ids come from the
distributed running count of ``sources.batches`` (batch ``b`` takes rows
``b * take ..`` of *every* partition, or the next ``take`` rows of one order),
rows lie sorted by batch in folders of ``GROUP`` batches.  ``run_replay`` drives
it: Spark's ``rate-micro-batch`` source gives one number a trigger, logged in the
checkpoint before the micro-batch runs, and batch ``number mod batches`` is read
with its folder pruned and its id pushed to the scan.  So a micro-batch that
failed, or was cut off by a restart, reads the very same rows again, and cyclic
replay costs nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.ordered import QuantileChunk
from tidepool.sources.batches import with_batch_id, with_partitioned_batch_id
from tidepool.streaming.runner import checkpoint_location

#: Batches of a folder.
GROUP = 1_000


def write_replay(df: DataFrame, path: str, order: Sequence[str], take: int, chunk: QuantileChunk, part: str | None = None,
                 group: int = GROUP) -> None:
    """Lay ``df`` out for replay; with ``part`` every batch takes ``take`` rows of each of its values."""
    batched = (with_partitioned_batch_id(df, part, order, take, chunk) if part else with_batch_id(df, order, take, chunk))
    keys = [F.col("batch_id"), *([F.col(part)] if part else []), *order]
    # a folder's rows come from a few tasks: of each batch id one, so that a batch is few files
    placed = batched.withColumn("batch_group", F.expr(f"batch_id div {int(group)}")).repartition("batch_group", "batch_id")
    placed.sortWithinPartitions("batch_group", *keys).write.partitionBy("batch_group").parquet(path)


class Replay:
    """A table written by ``write_replay``."""

    def __init__(self, spark: SparkSession, path: str, group: int = GROUP):
        self.spark, self.group = spark, group
        self.rows = spark.read.parquet(path)
        top = self.rows.agg(F.max("batch_id")).first()[0]
        #: Number of batches.
        self.batches = 0 if top is None else top + 1

    def batch(self, number: int) -> DataFrame:
        """The rows of the ``number``-th batch of the stream, with that number as ``batch_id``."""
        b = number % self.batches
        here = self.rows.where((F.col("batch_group") == b // self.group) & (F.col("batch_id") == b))
        return here.drop("batch_group").withColumn("batch_id", F.lit(number).cast("long"))


def run_replay(replay: Replay, name: str, body: Callable[[DataFrame, int], None], cycles: int | None = 1, checkpoint: str | None = None,
               processing_time: str = "0 seconds") -> None:
    """Run ``body(rows, batch id)`` on every batch, ``cycles`` times over (None: until the query is stopped elsewhere)."""
    if cycles is not None and cycles < 1:
        raise ValueError("cycles must be >= 1")
    if not replay.batches:
        return
    last = None if cycles is None else replay.batches * cycles
    spark, done = replay.spark, [False]

    def one(numbers: DataFrame, batch_id: int) -> None:
        for r in numbers.collect():  # one number
            if last is None or r["value"] < last:
                body(replay.batch(r["value"]), r["value"])
            done[0] = last is not None and r["value"] + 1 >= last

    q = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
         .writeStream.queryName(name).foreachBatch(one).trigger(processingTime=processing_time)
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name)).start())
    while q.isActive and not done[0]:
        time.sleep(0.05)
    if done[0]:
        q.stop()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
