"""Small integer and time arithmetic used by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Fixed value: size of a count-of-counts bucket.
BUCKET_SIZE = 10


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _epoch_ntz() -> Column:
    # A typed SQL literal: a Python datetime would pass through the session zone.
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, TimestampNTZType)


def micros(ts: str | Column, ntz: bool = True) -> Column:
    """Microseconds since the epoch, independent of the session time zone:
    a ``timestamp_ntz`` wall-clock value counts from 1970-01-01 00:00 on the
    same clock; a ``timestamp`` instant counts from the UTC epoch."""
    c = _c(ts)
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), c) if ntz else F.unix_micros(c)


def from_micros(us: Column, ntz: bool = True) -> Column:
    """Inverse of ``micros``."""
    return F.timestamp_add("MICROSECOND", us, _epoch_ntz()) if ntz else F.timestamp_micros(us)


def elapsed_seconds(now: str | Column, then: str | Column) -> Column:
    """Whole seconds from ``then`` to ``now``, truncated (P12).  Both sides
    must have the same timestamp type; a microsecond difference does not
    depend on the session time zone for either type."""
    diff = F.timestamp_diff("MICROSECOND", _c(then), _c(now))
    return (diff / F.lit(1_000_000)).cast("long").cast("int")


def bucket(count: str | Column, size: int = BUCKET_SIZE) -> Column:
    """Integer bucket ``count div size`` for non-negative counts."""
    if size < 1:
        raise ValueError("bucket size must be >= 1")
    return F.floor(_c(count) / F.lit(size)).cast("long")


def slot_start(ts: str | Column, slot_seconds: int, ntz: bool = True) -> Column:
    """Start of the epoch-aligned slot of ``slot_seconds`` holding ``ts``, of
    the same timestamp type as ``ts``."""
    us = slot_seconds * 1_000_000
    start_us = F.floor(micros(ts, ntz) / F.lit(us)) * F.lit(us)
    return from_micros(start_us.cast("long"), ntz)
