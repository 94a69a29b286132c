"""Fill-in-middle against plain regular expressions, and the Fenwick descent against counting."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidepool.llm import fill_middle


def brute(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    rng = random.Random(11)
    made = ["".join(rng.choice(["\n", "\n\n", "\r\n", "a", "é", "\U0001f600", "<", "<P", "S>", " ", " ", "\x0b"])
                    for _ in range(rng.randrange(0, 400))) for _ in range(300)]
    return [None, "", "\n", "\n\n\n", "one", "one\n", "a<P>b\nc", "x\n<M>", "<S", prose(rng, 9000), ("é" * 4095 + "\n") * 7,
            "\U0001f600" * 3000 + "\nend", "\n" * 20_000, *made]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 4096])
def test_cuts(block):
    for t in odd_texts():
        t = (t or "")[:3000]
        lines = re.findall(r"[^\n]*\n|[^\n]+", t)
        found = fill_middle.Blocks(t.encode(), block)
        assert found.n == len(lines) and found.n_chars == len(t)
        for k in {0, 1, len(lines) // 2, max(len(lines) - 1, 0), len(lines)}:
            head = "".join(lines[:k])
            assert found.cut(k) == (len(head.encode()), len(head))


@pytest.mark.parametrize("settings", [{}, {"seed": 3, "rate": 40, "spm": 0}, {"rate": 0}, {"spm": 100}])
def test_table(spark, settings):
    rows = [*enumerate(odd_texts()), (None, "no id\nhere\n"), (7, "same id\n"), (7, "same id\n")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, form string, n int").repartition(3)
    out = fill_middle.transform(docs, **settings)
    assert out.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_middle.restored().alias("back"), "text").collect()
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(str(brute(i, t, **settings)) for i, t in rows)
    assert all(r["back"] == (r["text"] or "") for r in got)


def test_digests(spark, odd, odd_rows, empty):
    expected = []
    for r in odd_rows:
        *row, out = brute(r[0], r[1])
        expected.append((*row, *(hashlib.sha256(x.encode()).hexdigest() for x in (out, r[1] or ""))))
    got = fill_middle.digests(odd)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
    assert fill_middle.digests(empty).count() == 0
    with pytest.raises(ValueError):
        fill_middle.transform(odd, rate=101)


def test_one_pass(spark, odd):
    plan = fill_middle.digests(odd.where(F.col("doc_id") > 0))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1  # the fixture's own repartition
