"""Property tests named in the survey's test plan: W7 == W4 and R5 == R1 on
random inputs (ties included)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidepool.operators import ranking as R
from tidepool.operators import windows as W

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3600)), max_size=80),
       slide=st.sampled_from([60, 300, 600]), n=st.integers(2, 5))
def test_slot_preaggregated_windows_equal_direct(spark, rows, slide, n):
    df = spark.createDataFrame([(o, T0 + dt.timedelta(seconds=s)) for o, s in rows], "obj string, ts timestamp_ntz")
    direct = W.sliding_count(df, "obj", "ts", n * slide, slide)
    slots = W.sliding_count_slots(df, "obj", "ts", n * slide, slide)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, slots.collect()))


@SETTINGS
@given(counts=st.lists(st.integers(0, 6), min_size=0, max_size=60), n=st.integers(1, 12),
       buckets=st.integers(1, 5))
def test_two_phase_ranking_equals_single(spark, counts, n, buckets):
    df = spark.createDataFrame([(f"o{i}", c) for i, c in enumerate(counts)], "obj string, count long")
    one = R.rank_top(df, "obj", "count", n).select("rank", "obj", "count").collect()
    two = R.rank_two_phase(df, "obj", "count", n, buckets=buckets).select("rank", "obj", "count").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    assert [r["rank"] for r in sorted(one, key=lambda r: r["rank"])] == list(range(1, min(n, len(counts)) + 1))
