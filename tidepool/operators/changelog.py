"""Batch-id driven counters in batch form.

A replay of these over the same batches gives the same rows: each result
is a function of the batch ids, never of how often a batch was seen
(decision D2: the idempotence guard is applied everywhere).  The streaming
forms, which keep versioned state across micro-batches, live in
``tidepool.streaming.versioned``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timeops import BUCKET_SIZE, bucket
from tidepool.operators.ordered import CHUNKS, quantile_chunk, running_total


def count_changelog(df: DataFrame, key: str, batch_col: str = "batch_id",
                    chunks: int = CHUNKS) -> DataFrame:
    """For every (batch, key) the batch touched, the key's cumulative
    count after the batch and before it (``prev_count``, null at first sight).
    Batches of a hot key are chunked by quantiles of the batch id over the
    input rows, so the bounds need no aggregate of their own."""
    per = df.groupBy(batch_col, key).agg(F.count(F.lit(1)).alias("_tp_n"))
    run = running_total(per, [key], [batch_col], quantile_chunk(df, batch_col, chunks), "count", value="_tp_n")
    prev = F.col("count") - F.col("_tp_n")
    return run.select(batch_col, key, "count",
                      F.when(prev == 0, F.lit(None).cast("long")).otherwise(prev).alias("prev_count"))


def bucket_deltas(changelog: DataFrame, size: int = BUCKET_SIZE, batch_col: str = "batch_id") -> DataFrame:
    """``+1`` into the current bucket for a new key; ``+1`` into the new
    and ``-1`` out of the old bucket when a key moved; nothing otherwise."""
    curr = bucket("count", size)
    prev = bucket("prev_count", size)
    plus = F.struct(curr.alias("bucket"), F.lit(1).alias("delta"))
    minus = F.struct(prev.alias("bucket"), F.lit(-1).alias("delta"))
    moves = (F.when(F.col("prev_count").isNull(), F.array(plus))
             .when(curr != prev, F.array(plus, minus))
             .otherwise(F.array().cast("array<struct<bucket:bigint,delta:int>>")))
    return (changelog.select(batch_col, F.explode(moves).alias("_tp_d"))
            .select(batch_col, F.col("_tp_d.bucket").alias("bucket"), F.col("_tp_d.delta").alias("delta")))


def bucket_changelog(deltas: DataFrame, batch_col: str = "batch_id", chunks: int = CHUNKS,
                     batches: DataFrame | None = None) -> DataFrame:
    """A11 + T3: per batch, the running count of every bucket the batch
    touched (a touched bucket is reported even when its deltas cancel).
    ``batches`` is a cheaper table of the same batch ids, such as the input of
    the changelog, to take the chunks' bounds from."""
    per = deltas.groupBy(batch_col, "bucket").agg(F.sum("delta").cast("long").alias("_tp_d"))
    run = running_total(per, ["bucket"], [batch_col], quantile_chunk(per if batches is None else batches, batch_col, chunks), "count", value="_tp_d")
    return run.select(batch_col, "bucket", "count")
