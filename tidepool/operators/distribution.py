"""Row distribution and stream plumbing.

In the reference these are wiring choices between tasks.  In Spark most are
implied by the operator that needs them (a ``groupBy`` or join shuffles on
its keys; a global aggregate does partial + final), so the helpers below
exist for the cases where a user wants them explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, n: int) -> DataFrame:
    """H1 shuffle grouping: round-robin rows evenly over ``n`` partitions."""
    return df.repartition(n)


def by_fields(df: DataFrame, cols: Sequence[str], n: int | None = None) -> DataFrame:
    """H2 fields grouping: equal keys land in the same partition."""
    return df.repartition(n, *cols) if n else df.repartition(*cols)


def copies_for(df: DataFrame, n: int, out: str = "task") -> DataFrame:
    """H4 all grouping for consumers that aggregate or join: every row once per
    consumer, tagged where it lies.  What a consumer does with its copies decides
    what is shuffled, so no task has to take a whole copy of the table."""
    if n < 1:
        raise ValueError("all grouping needs one consumer or more")
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def replicate(df: DataFrame, n: int, out: str = "task") -> DataFrame:
    """H4 all grouping with each consumer in one task: ``copies_for`` dealt by
    the tag.  A task takes a whole copy, so this is for small tables."""
    return copies_for(df, n, out).repartition(n, out)


def route(df: DataFrame, rules: Mapping[str, Column], default: str = "default",
          out: str = "stream") -> DataFrame:
    """H5 named output streams: tag each row with the first matching stream."""
    tag = None
    for name, cond in rules.items():
        tag = F.when(cond, F.lit(name)) if tag is None else tag.when(cond, F.lit(name))
    tag = F.lit(default) if tag is None else tag.otherwise(F.lit(default))
    return df.withColumn(out, tag)


def stream(df: DataFrame, name: str, col: str = "stream") -> DataFrame:
    """The consumer side of H5: one named stream."""
    return df.filter(F.col(col) == F.lit(name)).drop(col)


def merge_streams(inputs: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """Bag union by position; field names of each input may differ
    (``sentence`` vs ``word``) and are replaced by ``names``.  Works on
    streams as well as batches."""
    if not inputs:
        raise ValueError("merge_streams needs at least one input")
    out = inputs[0].toDF(*names)
    for d in inputs[1:]:
        out = out.union(d.toDF(*names))
    return out
