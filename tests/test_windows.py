"""Sliding windows, rolling counts and slot counters against the goldens."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepool.operators import windows as W

E = 60  # slot length in seconds
T0 = dt.datetime(2024, 1, 1)

# slots, increments per slot, expected count at the end of each slot (0 = no row)
SLIDING_GOLDENS = [
    (2, [3, 2, 0, 0, 1, 0, 0, 0], [3, 5, 2, 0, 1, 1, 0, 0]),
    (3, [3, 2, 0, 0, 1, 0, 0, 0], [3, 5, 5, 2, 1, 1, 1, 0]),
    (4, [3, 2, 0, 0, 1, 0, 0, 0], [3, 5, 5, 5, 3, 1, 1, 1]),
    (5, [3, 2, 0, 0, 1, 0, 0, 0], [3, 5, 5, 5, 6, 3, 1, 1]),
    (5, [3, 11, 5, 13, 7, 17, 0, 3, 50, 600, 7000], [3, 14, 19, 32, 39, 53, 42, 40, 77, 670, 7653]),
    (5, [1, 1, 1, 1, 0, 0, 0, 0], [1, 2, 3, 4, 4, 3, 2, 1]),
]


def _rows(spark, incs, obj="x"):
    rows = []
    for i, n in enumerate(incs):
        for j in range(n):
            rows.append((obj, T0 + dt.timedelta(seconds=i * E + (j % E))))
    return spark.createDataFrame(rows, "obj string, ts timestamp_ntz")


@pytest.mark.parametrize("fn", [W.sliding_count, W.sliding_count_slots])
@pytest.mark.parametrize("slots,incs,exp", SLIDING_GOLDENS)
def test_sliding_goldens(spark, fn, slots, incs, exp):
    df = _rows(spark, incs)
    out = fn(df, "obj", "ts", slots * E, E)
    got = {r["window_end"]: r["count"] for r in out.collect()}
    for i, e in enumerate(exp):
        end = T0 + dt.timedelta(seconds=(i + 1) * E)
        if e == 0:
            assert end not in got, (i, got.get(end))
        else:
            assert got.get(end) == e, (i, got.get(end), e)


@pytest.mark.parametrize("n", [-10, -3, -2, -1, 0, 1])
def test_illegal_window_lengths(spark, n):
    df = _rows(spark, [1])
    with pytest.raises(ValueError):
        W.sliding_count(df, "obj", "ts", n * E, E)


@pytest.mark.parametrize("n", [2, 3, 20])
def test_legal_window_lengths(spark, n):
    W.sliding_count(_rows(spark, [1]), "obj", "ts", n * E, E)


def test_empty_input_gives_no_rows(spark):
    df = spark.createDataFrame([], "obj string, ts timestamp_ntz")
    assert W.sliding_count(df, "obj", "ts", 5 * E, E).count() == 0
    assert W.sliding_count_slots(df, "obj", "ts", 5 * E, E).count() == 0


def test_rolling_count_actual_length(spark):
    # 9 s window, 3 s emit: ticks k = 1, 2, 3, 4 report 3, 6, 9, 9 seconds.
    rows = [("a", T0 + dt.timedelta(seconds=s)) for s in (0, 3, 6, 9)]
    df = spark.createDataFrame(rows, "obj string, ts timestamp_ntz")
    out = W.rolling_count(df, "obj", "ts", 9, 3).orderBy("window_end").collect()
    lengths = [r["actual_window_length_seconds"] for r in out][:4]
    assert lengths == [3, 6, 9, 9]
    assert [r["is_partial_window"] for r in out][:4] == [True, True, False, False]


def test_rolling_count_short_window_by_integer_division(spark):
    # L = 10 s, E = 3 s -> 3 slots, effective 9 s; the configured 10 s is never reached.
    rows = [("a", T0 + dt.timedelta(seconds=s)) for s in range(0, 30)]
    df = spark.createDataFrame(rows, "obj string, ts timestamp_ntz")
    out = W.rolling_count(df, "obj", "ts", 10, 3).collect()
    assert max(r["actual_window_length_seconds"] for r in out) == 9
    assert all(r["is_partial_window"] for r in out)
    assert max(r["count"] for r in out) == 9


def test_rolling_methods_agree(spark):
    rows = [(f"o{i % 7}", T0 + dt.timedelta(seconds=(i * 37) % 900)) for i in range(500)]
    df = spark.createDataFrame(rows, "obj string, ts timestamp_ntz")
    a = W.rolling_count(df, "obj", "ts", 300, 60, method="slots")
    b = W.rolling_count(df, "obj", "ts", 300, 60, method="expand")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ------------------------------------------------------------------ slots
def _slot_rows(spark, items):
    """items: (obj, slot index)"""
    rows = [(o, T0 + dt.timedelta(seconds=s * E)) for o, s in items]
    return spark.createDataFrame(rows, "obj string, ts timestamp_ntz")


def test_slot_counts_and_miss(spark):
    df = _slot_rows(spark, [("foo", 0)] * 3 + [("bar", 0)] * 2)
    c = W.slot_counts(df, "obj", "ts", E)
    probes = spark.createDataFrame([("foo", T0), ("bar", T0), ("unknown", T0)],
                                   "obj string, slot_start timestamp_ntz")
    got = {r["obj"]: r["count"] for r in W.slot_count_lookup(c, probes).collect()}
    assert got == {"foo": 3, "bar": 2, "unknown": 0}


def test_slot_isolation(spark):
    df = _slot_rows(spark, [("10", 1)])
    c = W.slot_counts(df, "obj", "ts", E)
    probes = spark.createDataFrame([("10", T0 + dt.timedelta(seconds=s * E)) for s in range(3)],
                                   "obj string, slot_start timestamp_ntz")
    got = [r["count"] for r in W.slot_count_lookup(c, probes).orderBy("slot_start").collect()]
    assert got == [0, 1, 0]


def test_slot_reset_and_zero_removal(spark):
    df = _slot_rows(spark, [("willBeRemoved", 0), ("willContinueToBeTracked", 0),
                            ("willContinueToBeTracked", 1)])
    c = W.slot_counts(df, "obj", "ts", E)
    wiped = {r["obj"]: r["total"] for r in W.slot_totals_excluding(c, F.lit(T0)).collect()}
    assert wiped == {"willBeRemoved": 0, "willContinueToBeTracked": 1}
    kept = {r["obj"]: r["total"] for r in W.slot_totals_excluding(c, F.lit(T0), drop_zeros=True).collect()}
    assert kept == {"willContinueToBeTracked": 1}


def test_slot_totals(spark):
    df = _slot_rows(spark, [("a", 0), ("a", 1), ("a", 5), ("b", 2)])
    got = {r["obj"]: r["total"] for r in W.slot_totals(W.slot_counts(df, "obj", "ts", E)).collect()}
    assert got == {"a": 3, "b": 1}


@pytest.mark.parametrize("n", [-10, -3, -2, -1, 0])
def test_illegal_slot_lengths(spark, n):
    with pytest.raises(ValueError):
        W.slot_counts(_slot_rows(spark, [("a", 0)]), "obj", "ts", n)
