"""Single join of any number of live streams.

All sides are one tagged stream, grouped by the join key.  A key's pending rows
are a ``MapState`` side -> row; the row that completes the key emits the joined
row and clears it.  The time-out runs in event time from the key's earliest
pending row: when the watermark passes it, a timer emits the pending rows of
*every* side as expired and clears the key, so state never holds a key longer
than the time-out plus the watermark's delay.  The same side of a pending key
arriving twice fails the query, whether in one micro-batch or in several.

State lives in the state store (RocksDB) and is committed with the micro-batch,
so a replayed micro-batch starts from the same pending rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidepool.operators.joins import SAME_SIDE_TWICE, infer_keys, resolve_out_fields
from tidepool.streaming.stateful import use_rocksdb
from tidepool.streaming.versioned import BatchOutput

JOINED, EXPIRED = "joined", "expired"
#: Event time twice: as microseconds, which state returns as they are, and for the watermark.
_SIDE, _TS, _MARK = "_tp_side", "_tp_us", "_tp_ts"


class SingleJoin(StatefulProcessor):
    """Pending rows of one key, a map from side to row."""

    def __init__(self, columns: Sequence[str], names: Sequence[str], keys: Sequence[str], fields: dict[str, int], row: StructType,
                 ts: str, timeout_seconds: int, on_duplicate: str):
        self.columns, self.names, self.keys, self.fields, self.row = list(columns), list(names), list(keys), dict(fields), row
        self.ts, self.timeout, self.on_duplicate = ts, timeout_seconds * 1_000_000, on_duplicate

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", StructType([StructField("side", IntegerType())]), self.row)

    def _emit(self, key, status: str, side: str | None, ts, rows: dict) -> Row:
        values = [rows[i][f] if i in rows else None for f, i in self.fields.items()]
        return Row("status", "side", *self.keys, self.ts, *self.fields)(status, side, *key, ts, *values)

    def _expire(self, key, rows: dict) -> Iterator[Row]:
        for i in sorted(rows):
            yield self._emit(key, EXPIRED, self.names[i], rows[i][_TS], {i: rows[i]})

    def _rows(self) -> dict:
        names = self.row.names
        return {k[0]: dict(zip(names, v)) for k, v in self.pending.iterator()}

    def _keep(self, rows: dict) -> None:
        self.pending.clear()
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        for i, r in rows.items():
            self.pending.updateValue((i,), tuple(r[n] for n in self.row.names))
        if rows:  # one past the time-out: a row at the very time-out still joins
            self.handle.registerTimer((min(r[_TS] for r in rows.values()) + self.timeout) // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._rows()
        for r in sorted((dict(zip(self.columns, r)) for r in rows), key=lambda r: (r[_TS], r[_SIDE])):
            side = r[_SIDE]
            old = {i: x for i, x in held.items() if r[_TS] - x[_TS] > self.timeout}
            if old:  # the key's time ran out before this row came
                yield from self._expire(key, held)
                held = {}
            elif any(x[_TS] - r[_TS] > self.timeout for x in held.values()):
                yield from self._expire(key, {side: r})  # itself too early for what is pending
                continue
            if side in held:
                if self.on_duplicate == "error":
                    raise ValueError(f"{SAME_SIDE_TWICE}: {self.names[side]} of {dict(zip(self.keys, key))}")
                continue
            held[side] = {n: r[n] for n in self.row.names}
            if len(held) == len(self.names):
                yield self._emit(key, JOINED, None, max(x[_TS] for x in held.values()), held)
                held = {}
        self._keep(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._expire(key, self._rows())
        self._keep({})

    def close(self) -> None:
        pass


def single_join_stream(sides: dict[str, DataFrame], out_fields: Sequence[str], ts: str, timeout_seconds: int, watermark: str,
                       keys: Sequence[str] | None = None, on_duplicate: str = "error") -> DataFrame:
    """Join the named streams ``sides`` on ``keys`` (default: their common
    fields but ``ts``); each side carries its event time as ``ts``.

    One stream comes out: ``status`` (``joined`` or ``expired``), ``side``
    (of an expired row), the keys, ``ts`` (of the last row joined, or of the
    expired row) and the other ``out_fields``, which an expired row fills from
    its own side only.  Rows of a micro-batch are taken in order of ``ts``;
    across micro-batches in order of arrival.  A null key is a key (J9).  A row
    behind the watermark is late and dropped by Spark; a row without a time is
    left out.  ``on_duplicate="ignore"`` keeps the first row of a side instead
    of failing."""
    if timeout_seconds < 0:
        raise ValueError("timeout must be >= 0")
    if on_duplicate not in ("error", "ignore"):
        raise ValueError("on_duplicate must be 'ignore' or 'error'")
    frames = [s.drop(ts) for s in sides.values()]
    keys = list(keys) if keys else infer_keys(frames)
    fields = resolve_out_fields(frames, keys, out_fields)
    kind = {f: frames[i].schema[f] for f, i in fields.items()}
    row = StructType([StructField(_TS, LongType()), *[StructField(f, k.dataType) for f, k in kind.items()]])
    tagged = None
    for i, s in enumerate(sides.values()):
        own = [F.col(f) if fields[f] == i else F.lit(None).cast(k.dataType).alias(f) for f, k in kind.items()]
        part = s.where(F.col(ts).isNotNull()).select(*keys, F.lit(i).alias(_SIDE), F.col(ts).cast("timestamp").alias(_MARK),
                                               F.unix_micros(F.col(ts).cast("timestamp")).alias(_TS), *own)
        tagged = part if tagged is None else tagged.unionByName(part)
    out = StructType([StructField("status", StringType()), StructField("side", StringType()),
                      *[StructField(k, frames[0].schema[k].dataType) for k in keys], StructField(ts, LongType()),
                      *[StructField(f, k.dataType) for f, k in kind.items()]])
    use_rocksdb(tagged.sparkSession)
    processor = SingleJoin(tagged.columns, list(sides), keys, fields, row, ts, timeout_seconds, on_duplicate)
    found = tagged.withWatermark(_MARK, watermark).groupBy(*keys).transformWithState(processor, out, "Append", "EventTime")
    return found.withColumn(ts, F.timestamp_micros(ts))


def joined_and_expired(joined: BatchOutput, expired: BatchOutput) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: the two kinds of rows to their own sinks, each overwritten per batch id."""

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        joined.write(batch.where(F.col("status") == JOINED).drop("status", "side"), batch_id)
        expired.write(batch.where(F.col("status") == EXPIRED).drop("status"), batch_id)
        batch.unpersist()

    return body
