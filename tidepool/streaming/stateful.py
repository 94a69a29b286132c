"""Keyed running state on streams (A1, T4) and per-batch ranking.

``row_number()`` is not allowed on a stream, so the per-row running count
keeps one ``ValueState`` per word in the state store (RocksDB) and emits one
row per input row.  Within a micro-batch a word's rows are counted in
``order``; across micro-batches in arrival order.  The state survives a
restart through the checkpoint, unlike the reference's in-heap map.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from tidepool.operators.ranking import rank_per_group
from tidepool.streaming.versioned import BatchOutput

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Processors keep their state in RocksDB, larger than memory."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class RunningCount(StatefulProcessor):
    """One ``ValueState`` (the word's count so far) per key.  ``ttl_ms``
    expires a word's count after that much processing time without updates
    (T5: state expiry), so idle keys do not hold state forever."""

    def __init__(self, order: Sequence[str], out: str, columns: Sequence[str], ttl_ms: int | None = None):
        self.order = list(order)
        self.out = out
        self.columns = list(columns)
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", StructType([StructField("c", LongType())]), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        prev = self.count.get()[0] if self.count.exists() else 0
        batch = pd.concat(list(rows), ignore_index=True)  # one word, one micro-batch
        if len(batch):
            batch = batch.sort_values(self.order, kind="stable").reset_index(drop=True)
            batch[self.out] = prev + pd.RangeIndex(1, len(batch) + 1)
            prev = int(batch[self.out].iloc[-1])
            self.count.update((prev,))
            yield batch[self.columns + [self.out]]

    def close(self) -> None:
        pass


def running_count_stream(df: DataFrame, word: str, order: Sequence[str], out: str = "count",
                         ttl_ms: int | None = None) -> DataFrame:
    """Streaming form of ``counts.running_count``: one output row per input row."""
    use_rocksdb(df.sparkSession)
    cols = df.columns
    schema = StructType([*df.schema.fields, StructField(out, LongType())])
    # State TTL is measured in processing time and needs that time mode; such a
    # query is meant to run on a processing-time trigger, not availableNow.
    time_mode = "ProcessingTime" if ttl_ms else "None"
    return df.groupBy(word).transformWithStateInPandas(RunningCount(order, out, cols, ttl_ms), schema,
                                                       "Append", time_mode)


class KeyedChangelog(StatefulProcessor):
    """T2 in the state store: per key and micro-batch, one row
    ``(key, count, prev_count)`` with the count after the batch and before it
    (null at first sight).  The store's versioned commits make a replayed
    micro-batch start from the same previous count (D2)."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", StructType([StructField("c", LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        n = sum(len(pdf) for pdf in rows)
        if n:
            prev = self.count.get()[0] if self.count.exists() else None
            total = (prev or 0) + n
            self.count.update((total,))
            yield pd.DataFrame({self.key: [key[0]], "count": [total], "prev_count": [prev]})

    def close(self) -> None:
        pass


def keyed_changelog_stream(df: DataFrame, key: str) -> DataFrame:
    """Streaming T2 on the state store (scales with the number of keys, no
    full-state rewrite per micro-batch).  Attach the batch id in the sink,
    e.g. ``BatchOutput.write`` inside ``foreachBatch``."""
    use_rocksdb(df.sparkSession)
    schema = StructType([df.schema[key], StructField("count", LongType()), StructField("prev_count", LongType())])
    return df.select(key).groupBy(key).transformWithStateInPandas(KeyedChangelog(key), schema, "Append", "None")


def ranking_each_batch(output: BatchOutput, groups: Sequence[str], obj: str, count: str, n: int):
    """R6 on a stream: ``foreachBatch`` body ranking every window that the
    (append-mode) windowed count finalised in this micro-batch.  Each window
    is ranked from scratch, so no stale entry survives (D7, D8)."""

    def body(batch: DataFrame, batch_id: int) -> None:
        output.write(rank_per_group(batch, list(groups), obj, count, n), batch_id)

    return body
