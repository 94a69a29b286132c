"""Exact dedup: the heavy and the shuffled part give what a dictionary gives."""

import hashlib
from collections import defaultdict

from tidepool.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = max(named) if named else None
        first = True
        for i in sorted(ids, key=lambda x: (x is None, -(x or 0))):
            out.append((i, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
            first = False
    return sorted(out, key=str)


def test_odd_rows(odd, odd_rows):
    got = X.exact_dedup(odd).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute([r[:2] for r in odd_rows])


def test_hot_group_goes_by_broadcast(spark):
    rows = [(i, "same") for i in range(3000)] + [(10_000 + i, f"text {i % 700}") for i in range(1400)]
    df = X.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str) == brute(rows)
    winners = X._heavy_winners(df.selectExpr("text_sha256 as __xd_digest", "doc_id"), "doc_id").collect()
    assert max(w["__xd_size"] for w in winners) == 3000 and len(winners) <= X.HEAVY


def test_empty_and_own_columns(empty, odd, odd_rows):
    assert X.exact_dedup(empty).count() == 0
    kept = X.drop_copies(odd)
    assert kept.columns == odd.columns
    assert {r["kept"] for r in kept.collect()} == {"yes"}  # the table's own column of that name
    assert kept.count() == len({r[1] or "" for r in odd_rows})


def test_hot_group_of_repeated_rows(spark):
    """Every id twice in one frequent text, all ids null in another: decided without their digest as a window's key."""
    rows = [(i // 2, "twice") for i in range(3000)] + [(None, "nameless")] * 2000 + [(10_000 + i, f"text {i % 700}") for i in range(1400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    df = X.exact_dedup(docs)
    assert sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str) == brute(rows)
    winners = X._heavy_winners(df.selectExpr("text_sha256 as __xd_digest", "doc_id"), "doc_id").collect()
    assert {(w["__xd_keep"], w["__xd_size"], w["__xd_tops"]) for w in winners} >= {(1499, 3000, 2), (None, 2000, 2000)}
