"""Readers for the driver's parquet tables.

Every query reads through ``table`` so that Catalyst sees a plain parquet scan
and can prune columns and push filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_words(spark: SparkSession, sf_dir: str, word: str = "event_type") -> DataFrame:
    """``events`` seen as a word stream: (event_id, ts, word, user_id)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", ev[word].alias("word"), "user_id")
