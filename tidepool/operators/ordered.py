"""Ordered per-key computations that stay parallel when one key is hot.

A plain ``row_number()/sum()/lag() OVER (PARTITION BY key ORDER BY ...)``
sends every row of a key to one task.  When one key holds a third of the
data that task holds a third of the data.  The helpers here cut each key's
ordering into *chunks* -- contiguous ranges of the order, given by a column
that never decreases along the order (a time bucket, ``id div width``,
``batch_id div width``) -- and

1. compute the per-row value inside each ``(key, chunk)`` window, which
   spreads a hot key over as many tasks as it has chunks;
2. compute one summary row per ``(key, chunk)`` with a partial (map-side)
   aggregate, so only the small summary is shuffled;
3. carry what earlier chunks contribute (a running offset for counts and
   sums, the last ``k`` values for a lag) with a window over the summary;
4. join the small carry table back on ``(key, chunk)``; the per-row side is
   already hash-partitioned on those columns by step 1, so it is not
   shuffled again (AQE turns the join into a broadcast when the summary is
   small at run time).

The result does not depend on the chunk width; the width only sets how much
of one key a task holds and how many rows the summary has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "_tp_chunk"
_KEY = "_tp_key"


def id_chunk(col: str | Column, width: int) -> Column:
    """Chunk of an integral, non-negative ordering column: ``col div width``."""
    if width < 1:
        raise ValueError("chunk width must be >= 1")
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(c / F.lit(width)).cast("long")


def time_chunk(ts: str | Column, seconds: int) -> Column:
    """Chunk of a timestamp (or timestamp_ntz) column: whole ``seconds``
    buckets.  Only monotonicity matters for a chunk, so the bucket may be
    taken on either clock."""
    if seconds < 1:
        raise ValueError("chunk width must be >= 1 second")
    c = F.col(ts) if isinstance(ts, str) else ts
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), c)
    return F.floor(us / F.lit(seconds * 1_000_000)).cast("long")


#: Chunks of an order by default.  A task holds at most about rows / CHUNKS rows of one key; raise it with the cluster.
CHUNKS = 64


@dataclass(frozen=True)
class QuantileChunk:
    """Chunk of an orderable number or time column: how many of ``chunks - 1``
    approximate quantiles of it (over ``source``) lie at or below it.

    The quantiles are a scalar subquery, computed when the query runs (no job
    while it is built) by a partial aggregate.  Chunks hold about equally many
    rows whatever the values are: an outlier, a burst or sparse ids do not
    change that.  Their number is fixed, so the summary of a key is at most
    ``chunks`` rows.  Rows of one very same value share a chunk.  A null is in
    chunk 0 (nulls sort first)."""

    source: DataFrame
    col: str
    chunks: int = CHUNKS

    def attach(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with the chunk as column ``out``."""
        if self.chunks < 1:
            raise ValueError("at least one chunk is needed")
        value = F.col(self.col)
        if self.chunks == 1:
            return df.withColumn(out, F.lit(0).cast("long"))
        shares = [i / self.chunks for i in range(1, self.chunks)]
        bounds = self.source.agg(F.percentile_approx(self.col, shares, 20 * self.chunks)).scalar()

        def place(b: Column, low: int, high: int) -> Column:
            """Binary search for the number of bounds at or below the value, known to be in [low, high]."""
            if low == high:
                return F.lit(low).cast("long")
            mid = (low + high) // 2
            return F.when(value >= b[mid], place(b, mid + 1, high)).otherwise(place(b, low, mid))

        # the bounds are a column of their own and a lambda variable, so the search tree holds them once
        found = F.transform(F.array("_tp_bounds"), lambda b: place(b, 0, self.chunks - 1))[0]
        return (df.withColumn("_tp_bounds", bounds)
                .withColumn(out, F.when(value.isNull(), F.lit(0).cast("long")).otherwise(found)).drop("_tp_bounds"))


def quantile_chunk(df: DataFrame, col: str, chunks: int = CHUNKS) -> QuantileChunk:
    """Chunks of about equally many rows along ``col``; see ``QuantileChunk``."""
    return QuantileChunk(df, col, chunks)


def with_chunk(df: DataFrame, chunk: Column | QuantileChunk, out: str = _CHUNK) -> DataFrame:
    return chunk.attach(df, out) if isinstance(chunk, QuantileChunk) else df.withColumn(out, chunk)


def _with_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Pack the key columns into one never-null struct column.

    Struct equality treats null fields as equal, so null keys keep their own
    group (as in ``PARTITION BY``), and the join below stays a plain
    equi-join on the very columns the window is partitioned by -- the per-row
    side is not shuffled a second time.
    """
    if not keys:
        return df, []
    return df.withColumn(_KEY, F.struct(*[F.col(k) for k in keys])), [_KEY]


def _attach(per_row: DataFrame, carry: DataFrame, part: Sequence[str]) -> DataFrame:
    """Join the per-(key, chunk) carry table onto the rows (inner: every
    (key, chunk) of the rows has a summary row)."""
    cols = [*part, _CHUNK]
    return per_row.join(carry, cols, "inner")


def _chunk_offsets(summary: DataFrame, part: Sequence[str]) -> DataFrame:
    """``(part, chunk, _tp_off)``: the total of all earlier chunks of the key,
    from its one row per chunk."""
    w = Window.partitionBy(*part).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(*part, _CHUNK, F.coalesce(F.sum("_tp_tot").over(w), F.lit(0)).alias("_tp_off"))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  chunk: Column | QuantileChunk, out: str, value: str | Column | None = None) -> DataFrame:
    """Add ``out`` = inclusive running count (``value`` None) or running sum of
    ``value`` per ``keys`` along ``order``.

    ``order`` must be a total order within a key (add a unique id as the last
    column) so the result is deterministic.  A key's summary has one row per
    chunk and is ordered in one task: use a chunking with a bounded number of
    chunks (``quantile_chunk``).
    """
    v = F.lit(1).cast("long") if value is None else (F.col(value) if isinstance(value, str) else value)
    d, part = _with_key(with_chunk(df, chunk).withColumn("_tp_v", v), list(keys))
    w_in = (Window.partitionBy(*part, _CHUNK).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    per_row = d.withColumn("_tp_local", F.sum("_tp_v").over(w_in))
    summary = d.groupBy(*part, _CHUNK).agg(F.sum("_tp_v").alias("_tp_tot"))
    carry = _chunk_offsets(summary, part)
    res = _attach(per_row, carry, part)
    return (res.withColumn(out, (F.col("_tp_local") + F.col("_tp_off")).cast("long"))
            .drop("_tp_v", "_tp_local", "_tp_off", _CHUNK, *part))


def running_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                chunk: Column | QuantileChunk, col: str, k: int, out: str) -> DataFrame:
    """Add ``out`` = value of ``col`` ``k`` rows earlier in the key's order
    (null when there is no such row), like ``lag(col, k)``.

    Rows in the first ``k`` positions of a chunk read from the last ``k``
    values of the preceding chunks; since every chunk holds at least one
    row, the ``k`` preceding chunks always suffice.  All carried lists hold
    at most ``k`` values per chunk, ``k`` a small operator parameter.  The
    carry window orders a key's chunks in one task, so use a chunking with a
    bounded number of chunks per key (``quantile_chunk``).
    """
    if k < 0:
        raise ValueError("lag offset must be >= 0")
    if k == 0:
        return df.withColumn(out, F.col(col))
    order = list(order)
    d, part = _with_key(with_chunk(df, chunk), list(keys))
    w_in = Window.partitionBy(*part, _CHUNK).orderBy(*order)
    per_row = (d.withColumn("_tp_pos", F.row_number().over(w_in))
               .withColumn("_tp_lag", F.lag(col, k).over(w_in)))
    desc_order = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    w_desc = Window.partitionBy(*part, _CHUNK).orderBy(*desc_order)
    # row_number() <= k over a partitioned window is planned as WindowGroupLimit,
    # so each map task forwards at most k rows per (key, chunk).
    tails = (d.select(*part, _CHUNK, *[o for o in order if isinstance(o, str)], col)
             .withColumn("_tp_rd", F.row_number().over(w_desc))
             .filter(F.col("_tp_rd") <= k)
             .groupBy(*part, _CHUNK)
             .agg(F.sort_array(F.collect_list(F.struct(F.col("_tp_rd").alias("rd"),
                                                       F.col(col).alias("v"))), asc=False)
                  .alias("_tp_tail")))
    tails = tails.withColumn("_tp_tail", F.transform("_tp_tail", lambda s: s["v"]))
    w_prev = Window.partitionBy(*part).orderBy(_CHUNK).rowsBetween(-k, -1)
    carry = tails.select(*part, _CHUNK,
                         F.flatten(F.collect_list("_tp_tail").over(w_prev)).alias("_tp_prev"))
    res = _attach(per_row, carry, part)
    from_prev = F.try_element_at(F.col("_tp_prev"), (F.col("_tp_pos") - F.lit(k + 1)).cast("int"))
    value = F.when(F.col("_tp_pos") > k, F.col("_tp_lag")).otherwise(from_prev)
    return res.withColumn(out, value).drop("_tp_pos", "_tp_lag", "_tp_prev", _CHUNK, *part)
