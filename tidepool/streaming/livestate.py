"""Queries against the running aggregate itself.

The word counts are a streaming aggregate kept in the state store; a batch query
reads the state of the newest committed micro-batch with Spark's state data
source while the writer goes on.  Nothing is copied per micro-batch: the writer
commits the keys it changed, the reader scans the store's partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.generators import tokens
from tidepool.operators.reach import lookup_sum
from tidepool.streaming.runner import checkpoint_location
from tidepool.streaming.stateful import use_rocksdb


def live_counts_job(rows: DataFrame, key: str, name: str, checkpoint: str | None = None, every: str | None = None) -> StreamingQuery:
    """Count ``rows`` per ``key`` in the state store.  Without ``every`` what is available now is processed and the
    query ends; with it the query keeps running on that cadence."""
    spark = rows.sparkSession
    use_rocksdb(spark)
    w = (rows.groupBy(key).agg(F.count(F.lit(1)).alias("count")).writeStream.queryName(name).outputMode("update").format("noop")
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name)))
    if every:
        return w.trigger(processingTime=every).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def live_counts(spark: SparkSession, key: str, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``(key, count)`` as of the newest committed micro-batch, or of ``batch_id`` where the store still keeps it."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select(F.col("key")[key].alias(key), F.col("value")["count"].alias("count"))


def live_words_query(requests: DataFrame, checkpoint: str, rule: str = "java", batch_id: int | None = None) -> DataFrame:
    """Q13 against the live counts: for each request ``(request_id, args)`` the sum of the counts of its words."""
    counts = live_counts(requests.sparkSession, "word", checkpoint, batch_id)
    return lookup_sum(tokens(requests, "args", rule, keep=("request_id",)), counts, requests=requests)[1]
