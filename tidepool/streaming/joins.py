"""Single join on streams (J6-J8 streaming forms, T5).

Pending keys are the join state; ``timeout`` bounds how far apart the sides
may arrive, and the watermark evicts pending keys once no partner can come.
That eviction is what the reference's time-out cache does; rows evicted
without a partner are the "failed" (expired) ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.joins import SAME_SIDE_TWICE, interval_join


def stream_single_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                       timeout_seconds: int, watermark: str, null_safe: bool = True) -> DataFrame:
    """J6 on two streams: emits a joined row as soon as both sides are in."""
    lw = left.withWatermark(left_ts, watermark)
    rw = right.withWatermark(right_ts, watermark)
    return interval_join(lw, rw, keys, left_ts, right_ts, timeout_seconds, "inner", null_safe)


def stream_join_expired(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                        timeout_seconds: int, watermark: str, null_safe: bool = True) -> DataFrame:
    """J7 on two streams: left rows whose partner never came within the
    time-out, emitted once the watermark has passed ``left_ts + timeout``.
    (Swap the arguments for the right side's expired rows.)"""
    lw = left.withWatermark(left_ts, watermark)
    rw = right.withWatermark(right_ts, watermark)
    j = interval_join(lw, rw, keys, left_ts, right_ts, timeout_seconds, "left_outer", null_safe)
    return j.filter(F.col(right_ts).isNull()).select(*keys, left_ts)


def unique_within_watermark(side: DataFrame, keys: Sequence[str], ts: str, watermark: str) -> DataFrame:
    """J8, lenient form: keep the first row of a key while it can still be
    pending (duplicates within the watermark are dropped)."""
    return side.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def guard_unique(keys: Sequence[str], body: Callable[[DataFrame, int], None] | None = None):
    """J8, strict form: a ``foreachBatch`` body that fails the micro-batch
    when it holds the same side of a key twice, then runs ``body``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        dup = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tp_n")).filter(F.col("_tp_n") > 1)
        if not dup.isEmpty():
            raise ValueError(f"{SAME_SIDE_TWICE} (batch {batch_id})")
        if body is not None:
            body(batch, batch_id)

    return run
