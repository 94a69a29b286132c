"""Request tables (S8, K2): many requests answered by one job.

The reference answers one blocking call at a time through an RPC server.
Here a request is a row ``(request_id, args)``; every pending request is
answered by the same plan and the answer keeps one row per request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def requests_from(df: DataFrame, id_col: str | Column, args_col: str | Column) -> DataFrame:
    rid = F.col(id_col) if isinstance(id_col, str) else id_col
    arg = F.col(args_col) if isinstance(args_col, str) else args_col
    return df.select(rid.cast("long").alias("request_id"), arg.alias("args"))


def requests_stream(spark, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming variant: request files landing in a directory."""
    return (spark.readStream.schema("request_id long, args string")
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def write_results(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: return ``(request_id, result...)`` rows to the caller as a table."""
    results.write.mode(mode).parquet(path)
