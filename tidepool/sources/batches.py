"""Batch-id assignment for replayable sources.

A batch is a slice of a stream identified by a ``batch_id``.  In batch mode
the id is derived from a dense row position along a total order, computed
without a global single-partition window: positions are counted per chunk of
the order and offset by the sizes of the earlier chunks (see
``tidepool.operators.ordered``).  In streaming mode the micro-batch id plays
this role (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` bound the batch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.ordered import QuantileChunk, running_total


def with_batch_id(df: DataFrame, order: Sequence[str], size: int, chunk: Column | QuantileChunk,
                  out: str = "batch_id") -> DataFrame:
    """Consecutive batches of at most ``size`` rows along ``order``."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    pos = running_total(df, [], order, chunk, "_tp_pos")
    return pos.withColumn(out, F.floor((F.col("_tp_pos") - 1) / F.lit(size)).cast("long")).drop("_tp_pos")


def with_partitioned_batch_id(df: DataFrame, part: str, order: Sequence[str], take: int, chunk: Column | QuantileChunk,
                              out: str = "batch_id") -> DataFrame:
    """Batch ``b`` takes rows ``b*take .. b*take+take-1`` of *every*
    partition (each partition read in ``order``)."""
    if take < 1:
        raise ValueError("the per-partition take must be >= 1")
    pos = running_total(df, [part], order, chunk, "_tp_pos")
    return pos.withColumn(out, F.floor((F.col("_tp_pos") - 1) / F.lit(take)).cast("long")).drop("_tp_pos")


def cycled(df: DataFrame, cycles: int, out: str = "cycle") -> DataFrame:
    """S5 ``setCycle``: replay a finite source ``cycles`` times (bounded), as a
    generator on each row -- no join."""
    if cycles < 1:
        raise ValueError("cycles must be >= 1")
    reps = F.sequence(F.lit(0).cast("long"), F.lit(cycles - 1).cast("long"))
    return df.select("*", F.explode(reps).alias(out))
