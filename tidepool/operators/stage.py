"""Materialising an intermediate result in the shared folder.

A chain of chunked steps reads its input once per branch; writing the
intermediate table to the folder named by ``spark.checkpoint.dir`` (shared
and durable on a cluster) cuts the lineage, so later steps -- and a retry
after a lost executor -- read the table instead of recomputing the chain.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under ``<spark.checkpoint.dir>/tidepool-stages/``
    (a fresh path per call, so no reader ever sees a rewrite) and return a
    DataFrame reading it.  Without a configured checkpoint folder the plan is
    returned unchanged -- never a machine-local temporary folder."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        return df
    path = f"{root.rstrip('/')}/tidepool-stages/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
