"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "rank", "obj", "count",
                          "actual_window_length_seconds", "is_partial_window"]
    assert df.count() > 0


def test_every_query_has_sql_and_keys_are_stable():
    q, s = E.queries(), E.oracle_sql()
    from tidepool.plans.catalog import QUERIES
    assert set(QUERIES) <= set(s) <= set(q)  # optional parts may hold queries without SQL
    assert len(QUERIES) >= 60
    assert all(callable(f) for f in q.values()) and all(isinstance(x, str) and x.strip() for x in s.values())
