"""Single join, key inference, time-out, uniqueness guard, null keys."""

import datetime as dt

import pytest

from tidepool.operators import joins as J

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def sides(spark):
    gender = spark.createDataFrame([(i, "male" if i % 2 == 0 else "female") for i in range(10)], "id int, gender string")
    age = spark.createDataFrame([(i, i + 20) for i in range(9, -1, -1)], "id int, age int")
    return gender, age


def test_example(spark, sides):
    out = J.single_join(list(sides), ["gender", "age"])
    got = sorted((r["age"], r["gender"]) for r in out.collect())
    assert got == [(20 + i, "male" if i % 2 == 0 else "female") for i in range(10)]
    assert out.columns == ["gender", "age"]


def test_key_inference(spark, sides):
    assert J.infer_keys(list(sides)) == ["id"]
    other = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        J.infer_keys([sides[0], other])


def test_missing_outfield(spark, sides):
    with pytest.raises(ValueError, match="no side of the join has"):
        J.single_join(list(sides), ["gender", "height"])


def test_ambiguous_outfield(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(1, "y")], "id int, v string")
    with pytest.raises(ValueError):
        J.single_join([a, b], ["v"], keys=["id"])


def test_three_way(spark, sides):
    extra = spark.createDataFrame([(i, f"n{i}") for i in range(0, 10, 3)], "id int, name string")
    out = J.single_join([*sides, extra], ["id", "name", "age"])
    assert sorted(tuple(r) for r in out.collect()) == [(0, "n0", 20), (3, "n3", 23), (6, "n6", 26), (9, "n9", 29)]


def test_missing_side_is_not_emitted(spark, sides):
    gender, age = sides
    partial = age.filter("id < 5")
    assert J.single_join([gender, partial], ["id"]).count() == 5


def test_same_side_twice(spark, sides):
    gender, age = sides
    dup = gender.unionByName(gender.filter("id = 3"))
    v = J.duplicate_keys([dup, age], ["id"], names=["gender", "age"]).collect()
    assert [(r["side"], r["id"], r["n"]) for r in v] == [("gender", 3, 2)]
    with pytest.raises(ValueError, match="more than once on one side"):
        J.single_join([dup, age], ["gender", "age"], on_duplicate="error")


def test_null_keys_match_when_null_safe(spark):
    a = spark.createDataFrame([(None, "m"), (1, "f")], "id int, gender string")
    b = spark.createDataFrame([(None, 30), (1, 40)], "id int, age int")
    assert J.single_join([a, b], ["gender", "age"], null_safe=True).count() == 2
    assert J.single_join([a, b], ["gender", "age"], null_safe=False).count() == 1


def test_timeout(spark):
    a = spark.createDataFrame([(1, T0), (2, T0), (3, T0)], "id int, a_ts timestamp_ntz")
    b = spark.createDataFrame([(1, T0 + dt.timedelta(seconds=5)), (2, T0 + dt.timedelta(seconds=50)),
                               (4, T0)], "id int, b_ts timestamp_ntz")
    got = J.interval_join(a, b, ["id"], "a_ts", "b_ts", 10).collect()
    assert [r["id"] for r in got] == [1]
    exp = sorted((r["side"], r["id"]) for r in J.join_expired(a, b, ["id"], "a_ts", "b_ts", 10, names=("a", "b")).collect())
    assert exp == [("a", 2), ("a", 3), ("b", 2), ("b", 4)]


def test_map_get(spark):
    req = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    state = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "key int, v string")
    got = sorted(((r["k"], r["v"]) for r in J.map_get(req, state, "k", "key", ["v"]).collect()), key=str)
    assert got == [(1, "x"), (1, "y"), (2, "z"), (3, None)]


def test_bucketed_interval_join_equals_plain_and_brute_force(spark):
    import random
    rnd = random.Random(7)
    a_rows = [(("hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 5)}"), T0 + dt.timedelta(seconds=rnd.randint(0, 200)))
              for _ in range(300)]
    b_rows = [(("hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 5)}"), T0 + dt.timedelta(seconds=rnd.randint(0, 200)))
              for _ in range(300)]
    a = spark.createDataFrame(a_rows, "id string, a_ts timestamp_ntz")
    b = spark.createDataFrame(b_rows, "id string, b_ts timestamp_ntz")
    for timeout in (0, 5, 37):
        got = sorted(tuple(r) for r in J.interval_join(a, b, ["id"], "a_ts", "b_ts", timeout, bucketed=True).collect())
        plain = sorted(tuple(r) for r in J.interval_join(a, b, ["id"], "a_ts", "b_ts", timeout, bucketed=False).collect())
        brute = sorted((ka, ta, tb) for ka, ta in a_rows for kb, tb in b_rows
                       if ka == kb and abs((ta - tb).total_seconds()) <= timeout)
        assert got == plain == brute
        exp = J.join_expired(a, b, ["id"], "a_ts", "b_ts", timeout, names=("a", "b")).collect()
        plain_exp = J.join_expired(a, b, ["id"], "a_ts", "b_ts", timeout, names=("a", "b"), bucketed=False).collect()
        assert sorted(map(tuple, exp)) == sorted(map(tuple, plain_exp))
        lonely_a = sorted((k, t) for k, t in a_rows
                          if not any(k == kb and abs((t - tb).total_seconds()) <= timeout for kb, tb in b_rows))
        lonely_b = sorted((k, t) for k, t in b_rows
                          if not any(k == ka and abs((t - ta).total_seconds()) <= timeout for ka, ta in a_rows))
        assert sorted((r["id"], r["ts"]) for r in exp if r["side"] == "a") == lonely_a
        assert sorted((r["id"], r["ts"]) for r in exp if r["side"] == "b") == lonely_b
