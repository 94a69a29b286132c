"""Streaming inputs (S7 and the streaming side of S1-S6).

A "feeder" in the reference appends tuples to a stream from the program.
Here rows land as files in a directory and a file stream picks them up;
``maxFilesPerTrigger`` bounds a micro-batch, like the reference's batch size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: StructType | str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """One of the driver's parquet tables read as a file stream."""
    if schema is None:
        schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(sf_dir)


def feed_stream(spark: SparkSession, path: str, schema: StructType | str,
                max_files_per_trigger: int = 1) -> DataFrame:
    """Every file written to ``path`` is one feed; one feed per trigger."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need ``timestamp`` (not ``timestamp_ntz``); with the session
    time zone at UTC the cast keeps the wall-clock value."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))
