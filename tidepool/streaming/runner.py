"""Starting streaming queries with their checkpoints in the shared folder.

Checkpoints live under the session's ``spark.checkpoint.dir`` (the cluster's
shared folder); a query that loses an executor, or restarts, resumes from
there.  Nothing is written to a machine-local temporary folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidepool.session import checkpoint_dir


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def run_available(df: DataFrame, name: str, output_mode: str = "append", sink: str = "memory",
                  path: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Process everything available now, then stop (``availableNow``).

    ``sink="memory"`` makes the result queryable as table ``name`` (tests);
    ``sink="parquet"`` appends to ``path``; ``sink="console"`` prints (K1).
    """
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
         .trigger(availableNow=True))
    if sink == "parquet":
        if not path:
            raise ValueError("a parquet sink needs a path")
        w = w.format("parquet").option("path", path)
    else:
        w = w.format(sink)
    q = w.start()
    q.awaitTermination()
    return q


def run_foreach_batch(df: DataFrame, name: str, body: Callable[[DataFrame, int], None],
                      output_mode: str = "append", checkpoint: str | None = None,
                      processing_time: str | None = None) -> StreamingQuery:
    """Run ``body(batch_df, batch_id)`` per micro-batch.  Without
    ``processing_time`` everything available is processed and the query stops;
    with it the query keeps running on that cadence (K5)."""
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
         .foreachBatch(body))
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
