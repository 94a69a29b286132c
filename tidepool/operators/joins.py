"""Keyed joins.

The reference's single join holds pending tuples in a hash map until every
side of a key has arrived.  In batch form that is an inner equi-join folded
over all sides; in streaming form an interval join whose time bound
(``timeout``) lets the watermark evict pending keys.  Spark (AQE) chooses
broadcast, shuffled-hash or sort-merge for each step; nothing is broadcast by
hand, so no side has to fit in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timeops import is_ntz, micros

SAME_SIDE_TWICE = "a key occurs more than once on one side of a single join"
MISSING_OUTFIELDS = "no side of the join has the requested field"


def infer_keys(sides: Sequence[DataFrame]) -> list[str]:
    """The keys are the field names common to every side (in the first
    side's order).  No common field is an error (decision D6)."""
    if len(sides) < 2:
        raise ValueError("a single join needs at least two sides")
    common = [c for c in sides[0].columns if all(c in s.columns for s in sides[1:])]
    if not common:
        raise ValueError("the sides of a single join share no field to join on")
    return common


def resolve_out_fields(sides: Sequence[DataFrame], keys: Sequence[str],
                       out_fields: Sequence[str]) -> dict[str, int]:
    """The side each requested non-key field comes from.  A field found in
    no side is the reference's error; a field in several sides must be
    renamed first (decision D11)."""
    where: dict[str, int] = {}
    for f in out_fields:
        if f in keys:
            continue
        hits = [i for i, s in enumerate(sides) if f in s.columns]
        if not hits:
            raise ValueError(f"{MISSING_OUTFIELDS}: {f!r}")
        if len(hits) > 1:
            raise ValueError(f"field {f!r} is in several sides {hits}; rename it in all but one")
        where[f] = hits[0]
    return where


def _key_eq(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else (left == right)


def single_join(sides: Sequence[DataFrame], out_fields: Sequence[str], keys: Sequence[str] | None = None,
                null_safe: bool = True, on_duplicate: str = "ignore") -> DataFrame:
    """Inner join of all sides on ``keys``; emits the requested fields in
    the requested order (P7).  Null keys match each other when ``null_safe``
    (J9: the reference keys on a ``List``, whose equality treats null = null).
    ``on_duplicate="error"`` first checks that no side repeats a key (J8)."""
    keys = list(keys) if keys else infer_keys(sides)
    for i, s in enumerate(sides):
        missing = [k for k in keys if k not in s.columns]
        if missing:
            raise ValueError(f"side {i} lacks key fields {missing}")
    where = resolve_out_fields(sides, keys, out_fields)
    if on_duplicate == "error":
        assert_unique_keys(sides, keys)
    elif on_duplicate != "ignore":
        raise ValueError("on_duplicate must be 'ignore' or 'error'")
    acc = sides[0].select(*keys, *[f for f, i in where.items() if i == 0])
    for i, side in enumerate(sides[1:], start=1):
        renamed = [F.col(k).alias(f"_tp_k{j}") for j, k in enumerate(keys)]
        own = [f for f, w in where.items() if w == i]
        right = side.select(*renamed, *own)
        cond = F.lit(True)
        for j, k in enumerate(keys):
            cond = cond & _key_eq(acc[k], right[f"_tp_k{j}"], null_safe)
        acc = acc.join(right, cond, "inner").drop(*[f"_tp_k{j}" for j in range(len(keys))])
    return acc.select(*out_fields)


def duplicate_keys(sides: Sequence[DataFrame], keys: Sequence[str],
                   names: Sequence[str] | None = None) -> DataFrame:
    """J8 as data: one row (side, keys..., n) per key that a side holds more
    than once.  Partial aggregation, so a hot key costs one row per task."""
    names = list(names) if names else [str(i) for i in range(len(sides))]
    out = None
    for name, s in zip(names, sides):
        v = (s.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
             .select(F.lit(name).alias("side"), *keys, "n"))
        out = v if out is None else out.unionByName(v)
    return out


def assert_unique_keys(sides: Sequence[DataFrame], keys: Sequence[str]) -> None:
    """J8 as an error, raised before the join runs (one small job)."""
    if not duplicate_keys(sides, keys).isEmpty():
        raise ValueError(SAME_SIDE_TWICE)


_BUCKET = "_tp_tb"


def _time_bucket(df: DataFrame, ts: str, width_seconds: int) -> Column:
    us = width_seconds * 1_000_000
    return F.floor(micros(ts, is_ntz(df, ts)) / F.lit(us)).cast("long")


def _bucketed(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str,
              timeout_seconds: int) -> tuple[DataFrame, DataFrame]:
    """Time buckets as an extra equi-key: rows within ``timeout`` of each
    other are at most one bucket apart, so the left row keeps its bucket and
    the right row is copied into its bucket and both neighbours.  Each
    matching pair meets in exactly one copy, and a hot key is spread over its
    time buckets instead of one join task."""
    width = max(int(timeout_seconds), 1)
    lb = left.withColumn(_BUCKET, _time_bucket(left, left_ts, width))
    b = _time_bucket(right, right_ts, width)
    rb = right.withColumn(_BUCKET, F.explode(F.array(b - 1, b, b + 1)))
    return lb, rb


def _interval_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                   timeout_seconds: int, null_safe: bool, right_prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & _key_eq(left[k], right[f"{right_prefix}{k}"], null_safe)
    if _BUCKET in left.columns and f"{right_prefix}{_BUCKET}" in right.columns:
        cond = cond & (left[_BUCKET] == right[f"{right_prefix}{_BUCKET}"])
    # Plain range predicates (not abs()) so streaming can derive state eviction.
    lo = left[left_ts] - F.expr(f"INTERVAL {int(timeout_seconds)} SECONDS")
    hi = left[left_ts] + F.expr(f"INTERVAL {int(timeout_seconds)} SECONDS")
    return cond & (right[right_ts] >= lo) & (right[right_ts] <= hi)


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                  timeout_seconds: int, how: str = "inner", null_safe: bool = True,
                  bucketed: bool | None = None) -> DataFrame:
    """The sides of a key join only when they arrive within
    ``timeout_seconds`` of each other; later arrivals have timed out.
    Output: the keys (from the left), then the other columns of both sides.

    ``bucketed`` (default: on for batch inner joins) adds time buckets to the
    join key so a hot key is split by time; streams keep the plain interval
    join, whose range predicate drives state eviction."""
    if timeout_seconds < 0:
        raise ValueError("timeout must be >= 0")
    if bucketed is None:
        bucketed = how == "inner" and not (left.isStreaming or right.isStreaming)
    if bucketed:
        left, right = _bucketed(left, right, left_ts, right_ts, timeout_seconds)
    r = right.select(*[F.col(c).alias(f"_tp_r_{c}") if c in keys or c == _BUCKET else F.col(c)
                       for c in right.columns])
    cond = _interval_cond(left, r, keys, left_ts, right_ts, timeout_seconds, null_safe, "_tp_r_")
    j = left.join(r, cond, how)
    return j.drop(*[f"_tp_r_{k}" for k in keys], _BUCKET, f"_tp_r_{_BUCKET}")


def join_expired(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                 timeout_seconds: int, names: tuple[str, str] = ("left", "right"),
                 null_safe: bool = True, bucketed: bool = True) -> DataFrame:
    """The rows of either side that found no partner within the time-out
    (the reference fails them on expiry): ``(side, keys..., ts)``.  Both anti
    joins carry time buckets in their equi-key (see ``interval_join``);
    ``bucketed=False`` skips that when no key can be hot (unique sides)."""
    if not bucketed:
        return _join_expired_plain(left, right, keys, left_ts, right_ts, timeout_seconds, names, null_safe)
    lb, rb = _bucketed(left, right, left_ts, right_ts, timeout_seconds)
    r = rb.select(*[F.col(c).alias(f"_tp_r_{c}") for c in rb.columns])
    cond_l = _interval_cond(lb, r, keys, left_ts, f"_tp_r_{right_ts}", timeout_seconds, null_safe, "_tp_r_")
    lonely_left = lb.join(r, cond_l, "left_anti").select(F.lit(names[0]).alias("side"), *keys,
                                                         F.col(left_ts).alias("ts"))
    # the other direction: right rows keep their bucket, left rows are copied
    rb2, lb2 = _bucketed(right, left, right_ts, left_ts, timeout_seconds)
    l2 = lb2.select(*[F.col(c).alias(f"_tp_l_{c}") for c in lb2.columns])
    cond_r = rb2[_BUCKET] == l2[f"_tp_l_{_BUCKET}"]
    for k in keys:
        cond_r = cond_r & _key_eq(rb2[k], l2[f"_tp_l_{k}"], null_safe)
    t = F.expr(f"INTERVAL {int(timeout_seconds)} SECONDS")
    cond_r = cond_r & (rb2[right_ts] >= l2[f"_tp_l_{left_ts}"] - t) & (rb2[right_ts] <= l2[f"_tp_l_{left_ts}"] + t)
    lonely_right = rb2.join(l2, cond_r, "left_anti").select(F.lit(names[1]).alias("side"), *keys,
                                                            F.col(right_ts).alias("ts"))
    return lonely_left.unionByName(lonely_right)


def _join_expired_plain(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                        timeout_seconds: int, names: tuple[str, str], null_safe: bool) -> DataFrame:
    t = F.expr(f"INTERVAL {int(timeout_seconds)} SECONDS")
    r = right.select(*[F.col(c).alias(f"_tp_r_{c}") for c in right.columns])
    cond_l = _interval_cond(left, r, keys, left_ts, f"_tp_r_{right_ts}", timeout_seconds, null_safe, "_tp_r_")
    lonely_left = left.join(r, cond_l, "left_anti").select(F.lit(names[0]).alias("side"), *keys,
                                                           F.col(left_ts).alias("ts"))
    l2 = left.select(*[F.col(c).alias(f"_tp_l_{c}") for c in left.columns])
    cond_r = F.lit(True)
    for k in keys:
        cond_r = cond_r & _key_eq(right[k], l2[f"_tp_l_{k}"], null_safe)
    cond_r = cond_r & (right[right_ts] >= l2[f"_tp_l_{left_ts}"] - t) & (right[right_ts] <= l2[f"_tp_l_{left_ts}"] + t)
    lonely_right = right.join(l2, cond_r, "left_anti").select(F.lit(names[1]).alias("side"), *keys,
                                                              F.col(right_ts).alias("ts"))
    return lonely_left.unionByName(lonely_right)


def single_join_outcome(sides: dict[str, DataFrame], keys: Sequence[str], ts: str, timeout_seconds: int) -> DataFrame:
    """J6 + J7 over any number of sides that hold a key at most once each:
    ``(status, side, keys..., ts)``.  A key whose sides all came within
    ``timeout_seconds`` of each other gives one ``joined`` row (side null, ts of
    the last one); otherwise each row it has gives an ``expired`` row.  One
    partial aggregate over all sides: a shuffle of one row per key and task
    however many sides there are."""
    if timeout_seconds < 0:
        raise ValueError("timeout must be >= 0")
    tagged = None
    for name, s in sides.items():
        part = s.where(F.col(ts).isNotNull()).select(*keys, F.lit(name).alias("side"), F.col(ts).alias("ts"))
        tagged = part if tagged is None else tagged.unionByName(part)
    per_side = [F.max(F.when(F.col("side") == name, F.col("ts"))).alias(f"_tp_{i}") for i, name in enumerate(sides)]
    per_key = tagged.groupBy(*keys).agg(*per_side)
    times = [F.col(f"_tp_{i}") for i in range(len(sides))]
    late = F.greatest(*times) if len(times) > 1 else times[0]
    early = F.least(*times) if len(times) > 1 else times[0]
    complete = late - early <= F.expr(f"INTERVAL {int(timeout_seconds)} SECONDS")
    for t in times:
        complete = complete & t.isNotNull()
    kind = tagged.schema["ts"].dataType
    rows = F.when(complete, F.array(F.struct(F.lit("joined").alias("status"), F.lit(None).cast("string").alias("side"), late.cast(kind).alias("ts"))))
    lonely = F.array(*[F.struct(F.lit("expired").alias("status"), F.lit(n).cast("string").alias("side"), t.alias("ts"))
                       for n, t in zip(sides, times)])
    rows = rows.otherwise(F.filter(lonely, lambda x: x["ts"].isNotNull()))
    return per_key.select(*keys, F.explode(rows).alias("_tp")).select("_tp.status", "_tp.side", *keys, "_tp.ts")


def map_get(requests: DataFrame, state: DataFrame, request_key: str, state_key: str,
            values: Sequence[str]) -> DataFrame:
    """Multi-get against a read-only keyed table; one row per match,
    one row with null values on a miss.

    Written as an inner join (AQE can split a hot key on either side of it)
    plus the misses from an anti join against the *distinct* state keys,
    rather than ``requests LEFT JOIN state``: a left outer join cannot split
    a hot key on its right side, so one task would hold all of that key's
    state rows."""
    s = state.select(F.col(state_key).alias("_tp_sk"), *values)
    hits = requests.join(s, requests[request_key] == s["_tp_sk"], "inner").drop("_tp_sk")
    keys = state.select(F.col(state_key).alias("_tp_sk")).dropDuplicates(["_tp_sk"])
    misses = requests.join(keys, requests[request_key] == keys["_tp_sk"], "left_anti")
    for v in values:
        misses = misses.withColumn(v, F.lit(None).cast(state.schema[v].dataType))
    return hits.unionByName(misses)
