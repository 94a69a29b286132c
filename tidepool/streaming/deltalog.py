"""Keyed totals as a log of changes (T2, T3, K4) and the running count of a hot word on a stream (A1, T4).

Micro-batch ``v`` writes only the keys it touched, ``(keys, count, prev_count)``,
as delta ``v``; after every ``every`` batches the deltas are merged with the last
base (per key the newest batch wins) into a new base.  A batch so costs its own
keys, not all keys.  A base is laid out in ``slices`` folders by the hash of the
keys, and a batch reads only the folders of keys it holds.

Batch ``v`` reads the newest base *below* ``v`` and the deltas between, and
overwrites delta ``v`` (and base ``v``, where one is due): replaying a batch
gives the very same files.  A missing delta is an error, never a silent zero.
Null keys are keys like any other, and keys keep their type.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidepool.functions.timeops import BUCKET_SIZE
from tidepool.operators.changelog import bucket_deltas
from tidepool.operators.counts import running_count
from tidepool.operators.ordered import CHUNKS, quantile_chunk
from tidepool.streaming.versioned import BatchOutput, VersionedStore

_AT, _N, _SLICE = "_tp_at", "_tp_n", "_tp_slice"


class DeltaLog:
    """Totals per key under ``path``; ``keys`` is the DDL of the key columns."""

    def __init__(self, spark: SparkSession, path: str, keys: str, every: int = 16, slices: int = 256):
        if every < 1 or slices < 1:
            raise ValueError("every and slices must be >= 1")
        self.spark, self.path, self.every, self.slices = spark, path.rstrip("/"), every, slices
        fields = StructType.fromDDL(keys).fields
        self.keys = [f.name for f in fields]
        long = LongType()
        state = [StructField("count", long), StructField(_AT, long)]
        self._staged = VersionedStore(spark, f"{self.path}/staged", StructType([*fields, StructField(_N, long)]))
        self._deltas = VersionedStore(spark, f"{self.path}/delta", StructType([*fields, *state, StructField("prev_count", long)]))
        self._bases = VersionedStore(spark, f"{self.path}/base", StructType([*fields, *state, StructField(_SLICE, long)]))

    def _slice(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.slices)).cast("long")

    def state(self, upto: int, slices: Sequence[int] | None = None, below: int | None = None) -> DataFrame:
        """``(keys, count)`` after batch ``upto``, of the given slices, from the newest base below ``below``."""
        base = max((b for b in self._bases.versions() if b < (upto + 1 if below is None else below)), default=None)
        first = 0 if base is None else base + 1
        missing = sorted({*range(first, upto + 1)} - {*self._deltas.versions()})
        if missing:
            raise RuntimeError(f"no delta of batch {missing[0]} under {self.path}")
        cols = [*self.keys, "count", _AT]
        parts = [self._bases.read(base)] + [self._deltas.read(v).withColumn(_SLICE, self._slice()) for v in range(first, upto + 1)]
        if slices is not None:
            parts = [p.where(F.col(_SLICE).isin([int(s) for s in slices])) for p in parts]
        rows = reduce(DataFrame.unionByName, [p.select(*cols) for p in parts])
        return rows.groupBy(*self.keys).agg(F.max_by("count", _AT).alias("count"))

    def latest(self) -> DataFrame:
        """``(keys, count)`` after the newest batch known to be whole, for readers beside the writer: the batch
        before the newest delta, from a base that was finished before it."""
        vs = self._deltas.versions()
        if len(vs) < 2:
            return self.state(vs[0]) if vs and self._deltas_whole(vs[0]) else self.state(-1)
        last = vs[-1] if self._deltas_whole(vs[-1]) else vs[-2]
        return self.state(last, below=last)

    def _deltas_whole(self, v: int) -> bool:
        fs, _ = self._deltas._fs()
        return fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._deltas._version_path(v)}/_SUCCESS"))

    def before(self, rows: DataFrame, v: int) -> DataFrame:
        """``rows`` (with the key columns) with ``prev_count``: the key's total before batch ``v``, null if unseen.
        At most ``slices`` numbers come to the driver, to read only the folders concerned."""
        here = [r[0] for r in rows.select(self._slice().alias("s")).distinct().collect()]
        prev = self.state(v - 1, here).select(*[F.col(k).alias(f"_tp_{k}") for k in self.keys], F.col("count").alias("prev_count"))
        same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(prev[f"_tp_{k}"]) for k in self.keys])
        return rows.join(prev, same, "left").drop(*[f"_tp_{k}" for k in self.keys])

    def add(self, changes: DataFrame, v: int) -> DataFrame:
        """Add ``changes`` (keys and a signed amount ``_tp_n``, one row per key) as batch ``v``; the delta's rows."""
        self._staged.write(changes, v)  # one row per touched key: aggregated once, read by what follows
        per = self.before(self._staged.read(v), v)
        new = per.withColumn("count", F.coalesce("prev_count", F.lit(0)) + F.col(_N)).withColumn(_AT, F.lit(v).cast("long"))
        self._deltas.write(new, v)
        if (v + 1) % self.every == 0:
            self._compact(v)
        self._staged.prune(1)
        return self.delta(v)

    def delta(self, v: int) -> DataFrame:
        """``(keys, count, prev_count)`` of the keys batch ``v`` touched."""
        return self._deltas.read(v).drop(_AT)

    def _compact(self, v: int) -> None:
        whole = self.state(v, below=v).withColumn(_AT, F.lit(v).cast("long")).withColumn(_SLICE, self._slice())
        (whole.repartition(_SLICE).write.mode("overwrite").partitionBy(_SLICE).parquet(self._bases._version_path(v)))

    def prune(self) -> None:
        """Drop the bases but the newest two, and the deltas that the older of them holds (a replay of the newest
        batch and a reader beside the writer need no more).  Not called by itself: the deltas are the changelog."""
        old = self._bases.versions()
        if len(old) >= 2:
            self._bases.prune(2)
            self._deltas.prune(sum(v > old[-2] for v in self._deltas.versions()))


def logged_counter(log: DeltaLog, key: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body; the log's deltas are the changelog."""

    def body(batch: DataFrame, batch_id: int) -> None:
        log.add(batch.groupBy(key).agg(F.count(F.lit(1)).alias(_N)), batch_id)

    return body


def logged_bucket_counter(counts: DeltaLog, buckets: DeltaLog, key: str, size: int = BUCKET_SIZE) -> Callable[[DataFrame, int], None]:
    """T2 + G6 + T3: keyed counts, and how many keys have a count in each bucket (``buckets`` has the key ``bucket``)."""
    count = logged_counter(counts, key)

    def body(batch: DataFrame, batch_id: int) -> None:
        count(batch, batch_id)
        moves = bucket_deltas(counts.delta(batch_id).withColumn("batch_id", F.lit(batch_id).cast("long")), size)
        buckets.add(moves.groupBy("bucket").agg(F.sum("delta").cast("long").alias(_N)), batch_id)

    return body


def running_count_batches(log: DeltaLog, word: str, order: Sequence[str], output: BatchOutput, out: str = "count",
                          chunks: int = CHUNKS) -> Callable[[DataFrame, int], None]:
    """A1 on a stream with hot words: ``foreachBatch`` body that writes every row with the count of its word so far.

    Within the micro-batch the running count is the batch form's, which cuts a word's rows along ``order[0]`` (a number
    or a time) into chunks; the word's total of earlier batches, one row, is added.  No task holds a word's rows, and
    where the join with the totals is not a broadcast AQE splits a hot word's partition."""

    def body(batch: DataFrame, batch_id: int) -> None:
        per = batch.groupBy(word).agg(F.count(F.lit(1)).alias(_N))
        totals = log.add(per, batch_id).select(F.col(word).alias("_tp_w"), F.col("prev_count").alias("_tp_prev"))
        rows = running_count(batch, word, order, quantile_chunk(batch, order[0], chunks), out)
        joined = rows.join(totals, rows[word].eqNullSafe(totals["_tp_w"]), "left")
        output.write(joined.withColumn(out, F.col(out) + F.coalesce("_tp_prev", F.lit(0))).drop("_tp_w", "_tp_prev"), batch_id)

    return body
