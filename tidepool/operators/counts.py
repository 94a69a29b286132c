"""Keyed counts: running (A1, A8), total (A2), per batch (A3, A10),
cumulative (A4), constant-one (A6), count-of-counts histogram (A9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timeops import BUCKET_SIZE, bucket
from tidepool.operators.ordered import CHUNKS, QuantileChunk, quantile_chunk, running_total


def running_count(df: DataFrame, word: str, order: Sequence[str], chunk: Column | QuantileChunk,
                  out: str = "count") -> DataFrame:
    """A1: for every row, how many rows of its word came up to and including
    it in ``order``.  ``chunk`` (a column that never decreases along
    ``order``) spreads a hot word over many tasks; see ``ordered``."""
    return running_total(df, [word], order, chunk, out)


def word_count(df: DataFrame, word: str = "word", out: str = "count") -> DataFrame:
    """A2: total count per word (partial aggregation before the shuffle)."""
    return df.groupBy(word).agg(F.count(F.lit(1)).alias(out))


def batch_count(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """A3: rows per batch."""
    return df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("count"))


def keyed_batch_count(df: DataFrame, key: str, batch_col: str = "batch_id") -> DataFrame:
    """A10: rows per (batch, key)."""
    return df.groupBy(batch_col, key).agg(F.count(F.lit(1)).alias("count"))


def global_count(batch_counts: DataFrame, batch_col: str = "batch_id",
                 chunks: int = CHUNKS, batches: DataFrame | None = None) -> DataFrame:
    """A4: cumulative count over batches in id order, computed on the already
    aggregated per-batch rows; batches are chunked so that even the
    one-row-per-batch table is never ordered inside one task.  ``batches`` is a
    cheaper table of the same batch ids to take the chunks' bounds from."""
    return running_total(batch_counts, [], [batch_col], quantile_chunk(batch_counts if batches is None else batches, batch_col, chunks),
                         "global_count", value="count")


def group_one(df: DataFrame, keys: Sequence[str], out: str = "one") -> DataFrame:
    """Every group collapses to the constant 1 -- a distinct in disguise."""
    return df.select(*keys).dropDuplicates(list(keys)).withColumn(out, F.lit(1))


def count_histogram(df: DataFrame, key: str, size: int = BUCKET_SIZE) -> DataFrame:
    """How many keys have a total count in [0, size), [size, 2*size), ..."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_tp_n"))
    return (per_key.groupBy(bucket("_tp_n", size).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("count")))
