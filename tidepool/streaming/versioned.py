"""Replay-safe counters driven by the micro-batch id.

The reference guards each commit with the transaction id: a replayed batch
finds its own id in the store and changes nothing.  Here every micro-batch
``v`` reads state version ``v - 1`` and *overwrites* version ``v``; a replay
of ``v`` (after a failure, or a restart from the checkpoint) recomputes the
very same version from the very same input.  Outputs are written per batch
id in overwrite mode too, so the sinks never double-count.

Versions are tables in the shared folder (``spark.checkpoint.dir`` or a path
the caller gives), which also cuts the lineage from batch to batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.operators.changelog import bucket_deltas
from tidepool.functions.timeops import BUCKET_SIZE


class VersionedStore:
    """A table with one full version per batch id: ``<path>/version=<v>``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(conf), p

    def versions(self) -> list[int]:
        fs, p = self._fs()
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("version="):
                out.append(int(name.split("=", 1)[1]))
        return sorted(out)

    def _version_path(self, v: int) -> str:
        return f"{self.path}/version={v}"

    def read(self, v: int | None) -> DataFrame:
        if v is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._version_path(v))

    def read_before(self, v: int) -> DataFrame:
        """The state as it was before batch ``v``: version ``v - 1``, nothing
        else.  Batch ids have no gaps and a batch starts only after the one
        before it was written whole, so no marker file is needed, and a
        missing version is an error, never a silent restart from zero."""
        if v == 0:
            return self.read(None)
        fs, _ = self._fs()
        jvm = self.spark.sparkContext._jvm
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(self._version_path(v - 1))):
            raise RuntimeError(f"no state of batch {v - 1} under {self.path}")
        return self.read(v - 1)

    def latest(self) -> DataFrame:
        """The newest version that is known to be whole: the newest with a
        marker file, or where no markers are written the one before the newest."""
        vs = self.versions()
        fs, _ = self._fs()
        jvm = self.spark.sparkContext._jvm
        whole = [v for v in vs if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self._version_path(v)}/_SUCCESS"))]
        return self.read(whole[-1] if whole else vs[max(len(vs) - 2, 0)] if vs else None)

    def write(self, df: DataFrame, v: int) -> None:
        df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]) \
          .write.mode("overwrite").parquet(self._version_path(v))

    def prune(self, keep: int = 2) -> None:
        """Drop all but the newest ``keep`` versions."""
        fs, _ = self._fs()
        jvm = self.spark.sparkContext._jvm
        for v in self.versions()[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._version_path(v)), True)


class BatchOutput:
    """Per-batch output rows, replay-safe: ``<path>/batch_id=<v>`` overwritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def write(self, df: DataFrame, v: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch_id={v}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def _with_state(per: DataFrame, prev: DataFrame, key: str, how: str) -> DataFrame:
    """Join on the key as a never-null struct, so that a null key finds its
    state, as it finds its group in the batch form."""
    a = per.withColumn("_tp_k", F.struct(F.col(key).cast("string").alias("k"))).drop(key)
    b = prev.withColumn("_tp_k", F.struct(F.col(key).cast("string").alias("k"))).drop(key)
    return a.join(b, "_tp_k", how).withColumn(key, F.col("_tp_k.k")).drop("_tp_k")


def global_counter(store: VersionedStore, output: BatchOutput | None = None, keep: int = 2):
    """T1 (+A3, A4, K3): ``foreachBatch`` body keeping ``count`` (one row).
    Emits ``(count, global_count)`` per batch into ``output``."""

    def body(batch: DataFrame, batch_id: int) -> None:
        prev = store.read_before(batch_id).select(F.lit(0).cast("long").alias("count"),
                                                  F.col("count").alias("global_count"))
        n = batch.agg(F.count(F.lit(1)).alias("count")).withColumn("global_count", F.col("count"))
        # one row from the batch, at most one from the previous version
        total = n.unionByName(prev).agg(F.sum("count").cast("long").alias("count"),
                                        F.sum("global_count").cast("long").alias("global_count"))
        store.write(total.select(F.col("global_count").alias("count")), batch_id)
        if output is not None:
            output.write(total, batch_id)
        store.prune(keep)

    return body


def keyed_counter(store: VersionedStore, key: str, changelog: BatchOutput | None = None,
                  keep: int = 2):
    """T2 (+A10, K4): keyed running counts; emits ``(key, count, prev_count)``
    for the keys a batch touched, ``prev_count`` null at first sight.  The
    state is rewritten in full each batch (one row per key), which keeps
    versions independent; the guard bug of the reference is not copied (D2)."""

    def body(batch: DataFrame, batch_id: int) -> None:
        prev = store.read_before(batch_id).select(F.col("key").alias(key), F.col("count").alias("_tp_prev"))
        per = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_tp_n"))
        merged = _with_state(per, prev, key, "full_outer")
        new_count = F.coalesce("_tp_prev", F.lit(0)) + F.coalesce("_tp_n", F.lit(0))
        state = merged.select(F.col(key).cast("string").alias("key"), new_count.alias("count"))
        store.write(state, batch_id)
        if changelog is not None:
            touched = merged.filter(F.col("_tp_n").isNotNull()).select(
                F.col(key).alias("key"), new_count.alias("count"), F.col("_tp_prev").alias("prev_count"))
            changelog.write(touched, batch_id)
        store.prune(keep)

    return body


def bucket_counter(count_store: VersionedStore, bucket_store: VersionedStore, key: str,
                   changelog: BatchOutput | None = None, buckets: BatchOutput | None = None,
                   size: int = BUCKET_SIZE, keep: int = 2):
    """T2 + G6 + A11 + T3 in one body (the reference's TransactionalWords):
    keyed counts, then the count-of-counts histogram moved by +/-1 deltas.
    Emits ``(bucket, count)`` for the buckets the batch touched."""
    keyed = keyed_counter(count_store, key, None, keep=keep + 1)

    def body(batch: DataFrame, batch_id: int) -> None:
        prev = count_store.read_before(batch_id).select(F.col("key").alias(key), F.col("count").alias("_tp_prev"))
        per = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_tp_n"))
        touched = _with_state(per, prev, key, "left").select(
            F.lit(batch_id).cast("long").alias("batch_id"), F.col(key).cast("string").alias("key"),
            (F.coalesce("_tp_prev", F.lit(0)) + F.col("_tp_n")).alias("count"),
            F.col("_tp_prev").alias("prev_count"))
        if changelog is not None:
            changelog.write(touched.drop("batch_id"), batch_id)
        deltas = bucket_deltas(touched, size).groupBy("bucket").agg(F.sum("delta").cast("long").alias("_tp_d"))
        bprev = bucket_store.read_before(batch_id).select("bucket", F.col("count").alias("_tp_bc"))
        bmerged = deltas.join(bprev, "bucket", "full_outer")
        bcount = F.coalesce("_tp_bc", F.lit(0)) + F.coalesce("_tp_d", F.lit(0))
        bucket_store.write(bmerged.select("bucket", bcount.alias("count")), batch_id)
        if buckets is not None:
            buckets.write(bmerged.filter(F.col("_tp_d").isNotNull()).select("bucket", bcount.alias("count")), batch_id)
        keyed(batch, batch_id)
        bucket_store.prune(keep)

    return body
