"""Compression-distance toxicity: held-out accuracy and odd rows."""

import random
import zlib

import numpy as np

from tests.llm.conftest import prose
from tidepool.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    m = T.train(docs, labels)
    rows = T.rate(docs.select("doc_id", "text").join(labels, "doc_id"), m).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    caught = np.mean([r["predicted"] for r in held if r["toxic"]])
    wrong = np.mean([r["predicted"] for r in held if not r["toxic"]])
    assert caught > 0.6 and wrong < 0.05


def test_toxic_windows_gain():
    rng = random.Random(0)
    rows = [(prose(rng, 60), 0) for _ in range(80)] + [(f"{prose(rng, 30)} gruesomely {prose(rng, 30)}", 1) for _ in range(80)]
    m = T.fit(rows)
    assert b"gruesome" in m.toxic
    bad, fine = (np.mean([T.score(t.encode(), m) for t, y in rows if y == k]) for k in (1, 0))
    assert bad > 0.9 and fine < 0.1


def test_odd_rows(odd, empty, odd_rows):
    m = T.fit([("plain words here " * 9, 0)] * 12 + [("nasty words here " * 9, 1)] * 12)
    out = T.rate(odd, m)
    assert out.count() == len(odd_rows) and set(out.columns) == {*odd.columns, "predicted"}
    rows = out.collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert T.rate(empty, m).count() == 0


def test_without_labels(odd, empty):
    labels = empty.selectExpr("doc_id", "1 as toxic")
    assert {r["score"] for r in T.rate(odd, T.train(odd, labels)).collect()} == {0.0}
