"""Event-time slots and sliding windows.

Time is event time: a slot is an epoch-aligned bucket of ``slot_seconds``;
the window that "ticks" at ``end`` covers ``[end - n*slide, end)``.  Every
function accepts a batch or a streaming DataFrame; pass ``watermark`` for
streams (the time column must then be a ``timestamp``, not ``timestamp_ntz``).
Objects never appear with a zero count (decision D7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timeops import elapsed_seconds, is_ntz, slot_start
from tidepool.operators.guards import require_emit_seconds, require_slots, require_tracked, require_window_slots
from tidepool.operators.ordered import QuantileChunk, running_lag, time_chunk


def _dur(seconds: int) -> str:
    return f"{int(seconds)} seconds"


def _watermarked(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    return df.withWatermark(ts, watermark) if watermark else df


# --------------------------------------------------------------------- slots
def slot_counts(df: DataFrame, obj: str, ts: str, slot_seconds: int,
                watermark: str | None = None) -> DataFrame:
    """(obj, slot_start, count) for every (object, slot) that has rows."""
    require_emit_seconds(slot_seconds)
    d = _watermarked(df, ts, watermark)
    if watermark:
        g = d.groupBy(F.window(ts, _dur(slot_seconds)).alias("slot"), F.col(obj).alias("obj"))
        return g.agg(F.count(F.lit(1)).alias("count")).select("obj", F.col("slot.start").alias("slot_start"), "count")
    return (d.groupBy(F.col(obj).alias("obj"), slot_start(ts, slot_seconds, is_ntz(df, ts)).alias("slot_start"))
            .agg(F.count(F.lit(1)).alias("count")))


def slot_count_lookup(counts: DataFrame, probes: DataFrame) -> DataFrame:
    """W1 read path: the count of each probed (obj, slot_start); a miss reads 0."""
    c = counts.select(F.col("obj").alias("_o"), F.col("slot_start").alias("_s"), "count")
    j = probes.join(c, (probes["obj"].eqNullSafe(c["_o"])) & (probes["slot_start"] == c["_s"]), "left")
    return j.select(*[probes[x] for x in probes.columns], F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def slot_totals(counts: DataFrame) -> DataFrame:
    """Total over all live slots per object."""
    return counts.groupBy("obj").agg(F.sum("count").cast("long").alias("total"))


def slot_totals_excluding(counts: DataFrame, excluded_slot: Column, drop_zeros: bool = False) -> DataFrame:
    """Totals with one slot's contribution wiped (the object stays, with 0).
    ``drop_zeros`` applies P15: objects whose total is 0 leave the counter."""
    kept = F.when(F.col("slot_start") == excluded_slot, F.lit(0)).otherwise(F.col("count"))
    out = counts.groupBy("obj").agg(F.sum(kept).cast("long").alias("total"))
    return out.filter(F.col("total") > 0) if drop_zeros else out


def oldest_slot(df: DataFrame, ts: str, slot_seconds: int) -> Column:
    """The tail slot of a counter: the oldest slot with rows, from the input
    itself (a scalar subquery: one partial aggregate over a single column)."""
    return df.agg(F.min(slot_start(ts, slot_seconds, is_ntz(df, ts)))).scalar()


# ------------------------------------------------------------ sliding window
def _window_slots(window_seconds: int, slide_seconds: int) -> int:
    require_emit_seconds(slide_seconds)
    n = window_seconds // slide_seconds  # integer division, as the reference (D10)
    require_window_slots(n)
    return n


def sliding_count(df: DataFrame, obj: str, ts: str, window_seconds: int, slide_seconds: int,
                  watermark: str | None = None) -> DataFrame:
    """Count per object over the last n slots, at every slide.

    Spark expands each *row* into its n windows before the partial
    aggregate; ``sliding_count_slots`` avoids that for n >= 4 or so.
    """
    n = _window_slots(window_seconds, slide_seconds)
    d = _watermarked(df, ts, watermark)
    w = F.window(ts, _dur(n * slide_seconds), _dur(slide_seconds))
    return (d.groupBy(w.alias("w"), F.col(obj).alias("obj"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "obj", "count"))


def sliding_count_slots(df: DataFrame, obj: str, ts: str, window_seconds: int, slide_seconds: int,
                        watermark: str | None = None) -> DataFrame:
    """The same result as ``sliding_count`` computed the way a slot ring
    does it -- one count per (object, slot), then n slot rows per window.

    Only the per-slot rows (one per object and slot) are expanded n times,
    not the raw rows.  Works on streams as a chained window aggregation.
    """
    n = _window_slots(window_seconds, slide_seconds)
    d = _watermarked(df, ts, watermark)
    slots = (d.groupBy(F.window(ts, _dur(slide_seconds)).alias("slot"), F.col(obj).alias("obj"))
             .agg(F.count(F.lit(1)).alias("n")))
    w = F.window(F.window_time("slot"), _dur(n * slide_seconds), _dur(slide_seconds))
    return (slots.groupBy(w.alias("w"), "obj")
            .agg(F.sum("n").cast("long").alias("count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "obj", "count"))


def rolling_count(df: DataFrame, obj: str, ts: str, window_seconds: int, emit_seconds: int,
                  stream_start: Column | None = None, method: str = "slots",
                  watermark: str | None = None) -> DataFrame:
    """W6 + W8: ``(window_start, window_end, obj, count,
    actual_window_length_seconds, is_partial_window)``.

    The actual length at a tick is how much of the window the stream has
    covered so far: ``min(end - stream_start, n * emit)`` with the stream
    starting at the slot of its first row (k-th tick -> ``min(k, n) * emit``).
    ``is_partial_window`` is the reference's start-up warning: the actual
    length differs from the configured one.  Batch input derives the stream
    start with a scalar subquery; streams must pass ``stream_start``.
    """
    n = _window_slots(window_seconds, emit_seconds)
    if method == "slots":
        counts = sliding_count_slots(df, obj, ts, window_seconds, emit_seconds, watermark)
    elif method == "expand":
        counts = sliding_count(df, obj, ts, window_seconds, emit_seconds, watermark)
    else:
        raise ValueError("method must be 'slots' or 'expand'")
    if stream_start is None:
        if df.isStreaming:
            raise ValueError("streaming input needs an explicit stream_start")
        stream_start = df.agg(F.min(slot_start(ts, emit_seconds, is_ntz(df, ts)))).scalar()
    covered = elapsed_seconds(F.col("window_end"), stream_start.cast(df.schema[ts].dataType))
    actual = F.least(covered, F.lit(n * emit_seconds)).cast("int")
    return (counts.withColumn("actual_window_length_seconds", actual)
            .withColumn("is_partial_window", F.col("actual_window_length_seconds") != F.lit(window_seconds)))


# ------------------------------------------------- time since n-th last mark
def nth_last_modified(df: DataFrame, key: str, ts: str, tiebreak: str, n: int,
                      start_ts: Column | None = None, chunk_seconds: int = 86400,
                      out: str = "seconds_since_oldest", chunk: Column | QuantileChunk | None = None,
                      before_mark: bool = False) -> DataFrame:
    """For every mark (row) of a key, the whole seconds between it and the
    oldest of the key's last ``n`` marks, the ring being pre-filled with the
    start time.  That oldest mark is ``lag(ts, n - 1)`` in ``(ts, tiebreak)``
    order, or ``start_ts`` (default: the first mark of the input) when the
    key has fewer marks.  ``before_mark`` reads the age before the row's own
    mark is made, as the rolling counter does at each tick: the oldest of the
    previous ``n`` marks, ``lag(ts, n)``.  Hot keys are chunked by
    ``chunk_seconds`` (or an explicit ``chunk`` column, e.g.
    ``ordered.quantile_chunk``).
    """
    require_tracked(n)
    if start_ts is None:
        start_ts = df.agg(F.min(ts)).scalar()
    chunk = chunk if chunk is not None else time_chunk(ts, chunk_seconds)
    lagged = running_lag(df, [key], [ts, tiebreak], chunk, ts, n if before_mark else n - 1, "_tp_oldest")
    oldest = F.coalesce(F.col("_tp_oldest"), start_ts.cast(df.schema[ts].dataType))
    return lagged.withColumn(out, elapsed_seconds(F.col(ts), oldest)).drop("_tp_oldest")


__all__ = [
    "slot_counts", "slot_count_lookup", "slot_totals", "slot_totals_excluding", "oldest_slot",
    "sliding_count", "sliding_count_slots", "rolling_count", "nth_last_modified", "require_slots",
]
