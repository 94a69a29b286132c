"""Top-N rankings.

Order is count descending, ties broken by object ascending (decision D3), so
every ranking is deterministic.  Nothing here funnels raw rows into one task:
the global top-N is ``TakeOrderedAndProject`` (each partition keeps its own
top N before the merge), per-group top-N is ``row_number() <= N``, which
Spark plans as ``WindowGroupLimit`` on both sides of the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.render import render_item, render_list
from tidepool.operators.guards import require_top_n


def _order(obj: str, count: str) -> list[Column]:
    return [F.col(count).desc(), F.col(obj).asc()]


def with_fields(df: DataFrame, fields: Sequence[str], out: str = "fields") -> DataFrame:
    """Carry-along fields, kept as one ``array<string>`` next to the object."""
    return df.withColumn(out, F.array(*[F.col(f).cast("string") for f in fields]))


def validate_items(df: DataFrame, obj: str, count: str, on_invalid: str = "error") -> DataFrame:
    """A ranked item needs a non-null object and a count >= 0.
    ``error`` fails the job on the first bad row, ``drop`` filters them out."""
    ok = F.col(obj).isNotNull() & F.col(count).isNotNull() & (F.col(count) >= 0)
    if on_invalid == "drop":
        return df.filter(ok)
    if on_invalid == "error":
        # assert_true is null when the row is valid and fails the task otherwise;
        # used in a filter so that column pruning cannot remove the check.
        check = F.assert_true(ok, F.lit("ranked object must be non-null and its count >= 0"))
        return df.filter(check.isNull())
    raise ValueError("on_invalid must be 'error' or 'drop'")


def rank_top(df: DataFrame, obj: str, count: str, n: int = 10) -> DataFrame:
    """R1 (+R7, R9): the N largest counts, with a 1-based ``rank`` column."""
    require_top_n(n)
    top = df.orderBy(*_order(obj, count)).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*_order(obj, count))))


def rank_per_group(df: DataFrame, groups: Sequence[str | Column], obj: str, count: str, n: int = 10) -> DataFrame:
    """Top N within each group (a hash bucket of objects, a window)."""
    require_top_n(n)
    w = Window.partitionBy(*groups).orderBy(*_order(obj, count))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def rank_two_phase(df: DataFrame, obj: str, count: str, n: int = 10, buckets: int = 4,
                   bucket: Column | None = None) -> DataFrame:
    """Intermediate top-N per bucket of objects, then the total top-N of
    the merged intermediates.  Equal to ``rank_top`` (a property test checks it)."""
    require_top_n(n)
    b = bucket if bucket is not None else F.pmod(F.hash(F.col(obj)), F.lit(buckets))
    partial = rank_per_group(df.withColumn("_tp_bucket", b), ["_tp_bucket"], obj, count, n)
    return rank_top(partial.drop("rank", "_tp_bucket"), obj, count, n)


def latest_counts(df: DataFrame, obj: str, count: str, seq: str,
                  carry: Sequence[str] = ()) -> DataFrame:
    """R2: upsert by object -- the count with the highest ``seq`` replaces all
    earlier ones, even when it is lower.  ``seq`` must be unique per object
    (arrival order), otherwise the survivor among ties is arbitrary.
    Partial ``max_by`` aggregation, so a hot object costs one row per map task."""
    cols = [count, *carry]
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(seq)).alias("_tp_latest")
    agg = df.groupBy(obj).agg(latest)
    return agg.select(obj, *[F.col(f"_tp_latest.{c}").alias(c) for c in cols])


def merge_rankings(rankings: Sequence[DataFrame], obj: str, count: str, seq: str, n: int = 10) -> DataFrame:
    """Merge partial rankings (``seq`` orders them): union, upsert by
    object, rank the latest counts, keep N (exact, decision D8)."""
    if not rankings:
        raise ValueError("merge_rankings needs at least one ranking")
    merged = rankings[0]
    for r in rankings[1:]:
        merged = merged.unionByName(r)
    return rank_top(latest_counts(merged, obj, count, seq), obj, count, n)


def rank_distinct(df: DataFrame, obj: str, count: str, first_by: str | None = None) -> DataFrame:
    """Items are equal when object and count are equal (case-sensitive),
    whatever their extra fields; keep one per (obj, count).  ``first_by``
    picks which extra value survives, deterministically (its minimum)."""
    if first_by is None:
        return df.select(obj, count).dropDuplicates([obj, count])
    return df.groupBy(obj, count).agg(F.min(first_by).alias(first_by))


def ranking_rendered(ranked: DataFrame, obj: str, count: str, fields: str | None = None) -> DataFrame:
    """P10 per item: adds ``item`` = ``[obj|count|f1|...]``."""
    return ranked.withColumn("item", render_item(obj, count, fields))


def ranking_list_rendered(ranked: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """P10 per ranking: ``[item1, item2, ...]`` in rank order.  The input is an
    already ranked (so bounded, N rows per group) DataFrame with ``item``."""
    items = F.sort_array(F.collect_list(F.struct("rank", "item")))
    agg = ranked.groupBy(*groups).agg(items.alias("_tp_items"))
    return agg.select(*groups, render_list(F.transform("_tp_items", lambda s: s["item"])).alias("rankings"))
