"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidepool.session import checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where it is unset (tests, local runs) a folder of this machine."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        return checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="tidepool-llm-"))
    return checkpoint_dir(spark)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once under the shared folder and read back: it is computed
    once, its lineage ends, and any executor can read it again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table of this package that no plan reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
