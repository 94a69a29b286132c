"""Session construction and shared-folder lookup.

On a cluster the session is created by the launcher; the library only reads
settings from it.  ``get_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def _driver_memory() -> str:
    """Local mode runs everything in the driver JVM: give it about 60% of the
    machine, at most 16 GB (``TIDEPOOL_DRIVER_MEMORY`` overrides)."""
    if os.environ.get("TIDEPOOL_DRIVER_MEMORY"):
        return os.environ["TIDEPOOL_DRIVER_MEMORY"]
    try:
        with open("/proc/meminfo") as fh:
            kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        mb = max(1024, min(16 * 1024, int(kb / 1024 * 0.6)))
        return f"{mb}m"
    except (OSError, StopIteration, ValueError):
        return "4g"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidepool") -> SparkSession:
    """A session for tests, the bench and local runs.  The master and the
    number of shuffle partitions are set only where asked for, so a launcher's
    settings stand."""
    master = master or os.environ.get("TIDEPOOL_MASTER")
    parts = shuffle_partitions or os.environ.get("TIDEPOOL_SHUFFLE_PARTITIONS")
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = (
        builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", _driver_memory())
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset (tests) is a
    fallback installed; the fallback must itself be a shared path on a real
    cluster, never a machine-local temporary folder.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf)
        return conf
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is unset and no fallback was given")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
