"""The user-function surface agrees with the built-in forms."""

import pyarrow as pa
from pyspark.sql import functions as F

from tidepool.operators import generators as G
from tidepool.operators import udf as U


def _docs(spark):
    rows = [(1, " a  b  "), (2, ""), (3, "x y z"), (4, "one")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_udtf_and_arrow_equal_builtin_split(spark):
    docs = _docs(spark)
    builtin = {r["doc_id"]: r["n_tokens"] for r in G.token_counts(docs, "doc_id", "text", "python").collect()}
    arrow = {r["doc_id"]: r["n_tokens"] for r in U.arrow_token_counts(docs, "doc_id", "text").collect()}
    udtf = {r["doc_id"]: r["n"] for r in U.udtf_tokens(docs, "text", keep=("doc_id",))
            .groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    vec = {r["doc_id"]: r["n"] for r in U.arrow_udtf_tokens(docs, "doc_id", "text")
           .groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert builtin == arrow == udtf == vec == {1: 6, 2: 1, 3: 3, 4: 1}


def test_combiners(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("b", 5), ("a", 1)], "k string, v long").repartition(3)
    count = {r["k"]: r["value"] for r in U.combine_by_key(df, ["k"], "v", U.COUNT).collect()}
    total = {r["k"]: r["value"] for r in U.combine_by_key(df, ["k"], "v", U.SUM).collect()}
    one = {r["k"]: r["value"] for r in U.combine_by_key(df, ["k"], "v", U.ONE).collect()}
    assert count == {"a": 3, "b": 1} and total == {"a": 6, "b": 5} and one == {"a": 1, "b": 1}


def test_batch_aggregate(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "batch_id long, v long")
    got = {r["batch_id"]: r["value"] for r in U.batch_aggregate(df, "batch_id", "v", U.count_rows).collect()}
    assert got == {0: 2, 1: 1}


def test_combine_all_uses_zero(spark):
    empty = spark.createDataFrame([], "v long")
    assert U.combine_all(empty, "v", U.COUNT).collect()[0]["value"] == 0
    assert U.combine_all(empty, "v", U.ONE).collect()[0]["value"] == 1
    df = spark.createDataFrame([(i,) for i in range(10)], "v long").repartition(3)
    assert U.combine_all(df, "v", U.SUM).collect()[0]["value"] == 45
    assert U.combine_all(df, "v", U.COUNT).collect()[0]["value"] == 10


def test_arrow_split_works_on_pieces_of_a_batch():
    texts = ["a b " * 100] * 50 + [None, "", "x" * 5000, "c d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    pieces = list(U.text_pieces(batch, 1, size=2_000))
    assert pa.Table.from_batches(pieces).to_pylist() == batch.to_pylist()
    assert len(pieces) > 10 and max(p.num_rows for p in pieces) <= 6
    big = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(["a b " * 50_000] * 40)], names=["id", "text"])
    tables = list(U.SplitWordsArrow.func().eval(big))
    assert max(t.num_rows for t in tables) < 1_000_000 and sum(t.num_rows for t in tables) == 40 * 100_001
