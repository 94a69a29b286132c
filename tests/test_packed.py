"""Sorted lists as rows, and their union per key."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from tidepool.operators import packed as P
from tidepool.operators import reach as RE


def test_pack_and_unpack():
    rng = np.random.default_rng(1)
    lists = [np.sort(rng.integers(-2**63, 2**63 - 1, k)) for k in (1, 5, 3)] + [np.arange(-3, 900), np.array([7, 7])]
    sizes = np.array([len(x) for x in lists])
    packed = P.pack(np.concatenate(lists), np.cumsum(sizes) - sizes)
    counts, values = P.unpack(packed)
    assert counts.tolist() == sizes.tolist() and values.tolist() == np.concatenate(lists).tolist()
    counts, values = P.unpack(packed.slice(2, 2))
    assert counts.tolist() == [3, 903] and values.tolist() == np.concatenate(lists[2:4]).tolist()
    assert len(packed[3].as_py()) == 10 + 902  # one byte a small difference


@pytest.mark.parametrize("low, high", [(0, 1), (-5, 40), (2**62, 2**62 + 9), (-2**63, -2**63 + 9), (-2**62, 2**62), (-2**63, 2**63 - 1)])
def test_pairs_are_sorted_as_one_number(monkeypatch, low, high):
    rng = np.random.default_rng(2)
    of, codes = rng.integers(0, 3, 200), rng.choice(rng.integers(low, high, 20, endpoint=True), 200)
    own = sorted(set(zip(of.tolist(), codes.tolist(), strict=True)))
    if high - low < 2**61:
        monkeypatch.setattr(np, "lexsort", None)
    got = P._sorted_once(of, codes, 3)
    assert list(zip(*[x.tolist() for x in got], strict=True)) == own
    assert [len(x) for x in P._sorted_once(of[:0], codes[:0], 3)] == [0, 0]


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("most", [0, 10, 4_096])
def test_union_per_key(spark, monkeypatch, kind, most):
    monkeypatch.setattr(P, "PART", 7)
    monkeypatch.setattr(P, "PIECE", 20)
    rows = [(f"k{k}", (j * (k + 3)) % 50 if j % 11 else None) for k in range(9) for j in range(8 * k + 1)] + [(None, 1)]
    own = {}
    for k, v in rows:
        if k is not None:
            own.setdefault(k, set()).add(v)
    values = spark.createDataFrame(rows, "k string, v long").select("k", F.col("v").cast(kind).alias("v"))
    lists = P.lists_of(values, "k", "v")
    made = lists.collect()
    assert max(r["n"] for r in made) <= 7 and {r["k"] for r in made} == set(own)
    # two lists of a key meet: every list twice
    both = lists.unionByName(lists)
    for nulls in (True, False):
        found = P.union_per_key(both, "k", "v", LongType() if kind == "long" else StringType(), most, nulls).collect()
        n = {r["k"]: r["n"] for r in found if not r["pair"]}
        pairs = {}
        for r in found:
            if r["pair"]:
                pairs.setdefault(r["k"], set()).add(r["v"])
        assert not set(n) & set(pairs) and set(n) | set(pairs) == set(own)
        assert {**n, **{k: len(v) for k, v in pairs.items()}} == {k: len(v if nulls else v - {None}) for k, v in own.items()}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_requests_meet_lists_not_paths(spark, kind):
    """60 requests of 517 paths at most: one row each reaches the last step (31,000 paths before)."""
    req = spark.range(60).select(F.col("id").alias("request_id"), F.col("id").cast("string").alias("url"))
    hop1 = req.select("url", F.lit("hot").alias("tweeter"))
    hop2 = spark.range(500).select(F.lit("hot").alias("tweeter"), F.col("id").cast(kind).alias("follower"))
    rows = RE.reach_united(req, hop1, hop2, RE.LIST_PATHS, nulls=True).collect()
    assert sorted((r["request_id"], r["n"]) for r in rows) == [(i, 500) for i in range(60)]


@pytest.mark.parametrize("method", ["uniquer", "group_one"])
@pytest.mark.parametrize("most", [0, 3, 100])
def test_null_follower_is_one_where_rows_are_counted(spark, method, most):
    req = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, None), (None, "a"), (0, "b")], "request_id long, url string")
    hop1 = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "z"), ("b", None), (None, "x")], "url string, tweeter string")
    hop2 = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", 2), ("y", None), ("z", None), (None, 7)], "tweeter string, follower long")
    out = {r["request_id"]: r["reach"] for r in RE.reach(req, hop1, hop2, method=method, most=most).collect()}
    assert out == {0: 3, 1: 3, 2: 1, 3: 0, None: 0}
