"""Sparse suffix arrays against every window of 50 words."""

import random
from collections import defaultdict

import numpy as np

from tests.llm.conftest import prose
from tidepool.llm import suffix_dedup as S
from tidepool.llm.textvec import SPACED, Words


def brute(rows):
    """Words of each document that lie in a window that another document holds."""
    docs = {(i, t) if i is not None else t: (i, (t or "").encode().lower().split()) for i, t in rows}
    held = defaultdict(set)
    for key, (_, w) in docs.items():
        for k in range(len(w) - 49):
            held[tuple(w[k:k + 50])].add(key)
    out = defaultdict(set)
    for i, w in docs.values():
        for k in range(len(w) - 49):
            if len(held[tuple(w[k:k + 50])]) > 1:
                out[i].update(range(k, k + 50))
    return {i: s for i, s in out.items() if s}


def passages():
    rng = random.Random(12)
    rows = []
    for n in (49, 50, 51, 55, 75, 130):
        p = prose(rng, n)
        rows += [(1000 * n + k, f"{prose(rng, rng.randrange(0, 70))} {p} {prose(rng, rng.randrange(0, 70))}") for k in range(3)]
    hot = prose(rng, 64)
    rows += [(50 + k, f"{prose(rng, 20)} {hot} {prose(rng, 20)}") for k in range(80)]
    line = prose(rng, 60)
    rows.append((7777, f"{line} {prose(rng, 10)} {line}"))  # repeats itself only
    rows.append((7778, prose(rng, 400)))
    return rows


def test_against_windows(spark, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows] + passages()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, th int").repartition(5)
    got = defaultdict(set)
    out = S.repeats(df).collect()
    for r in out:
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
        assert r["end_word"] - r["start_word"] >= 50
    assert len(out) == len(set(out))
    expected = brute(rows)
    assert set(got) == set(expected) and all(got[i] <= expected[i] for i in got)
    # where eighty documents share a passage, two may also share the word before it
    short = {i: expected[i] - got[i] for i in got if expected[i] != got[i]}
    assert all(50 <= i < 130 and len(x) <= 3 for i, x in short.items())
    assert 7777 not in got and 7778 not in got


def test_empty(empty):
    assert S.repeats(empty).count() == 0


def test_every_long_span_has_a_selected_start():
    texts = [prose(random.Random(k), 40 + 60 * k).encode() for k in range(6)]
    w = Words(texts, SPACED)
    doc, pos = S._selected(w.hashes(), w.counts())
    for i, n in enumerate(w.counts()):
        mine = np.sort(pos[doc == i])
        for s in range(n - S.LEAST + 1):
            assert ((mine >= s) & (mine < s + S.WINDOW)).any()


def words_found(spark, rows):
    got = defaultdict(set)
    for r in S.repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect():
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    return got


def test_equal_to_windows(spark, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows] + passages()
    assert words_found(spark, rows) == brute(rows)


def test_passage_that_runs_into_a_hot_line(spark):
    rng = random.Random(4)
    line = prose(rng, 35)
    rows = [(k, f"{prose(rng, 30)} {line} {prose(rng, 30)}") for k in range(600)]
    for k in range(20):
        before = prose(rng, 16 + k % 10)  # 51 to 60 shared words
        rows += [(1000 + 2 * k + x, f"{prose(rng, 9)} {before} {line} {prose(rng, 30)}") for x in range(2)]
    expected = brute(rows)
    assert set(expected) == set(range(1000, 1040))
    assert words_found(spark, rows) == expected


def test_passage_many_times_in_one_document(spark):
    rng = random.Random(8)
    p = prose(rng, 90)
    rows = [(1, " ".join([p] * 12)), (2, f"{prose(rng, 20)} {p} {prose(rng, 20)}"),
            (3, " ".join(f"{prose(rng, 30)} {p}" for _ in range(12))), (4, " ".join([p] * 30))]
    assert words_found(spark, rows) == brute(rows)
    rows = [(1, " ".join(f"{p} {prose(rng, 30)}" for _ in range(20))), (2, f"{prose(rng, 20)} {p} {prose(rng, 20)}")]
    assert words_found(spark, rows) == brute(rows)


def test_equal_suffixes_of_one_text_are_all_credited():
    rows = [(5, b"a" * 108, b"", 1, 100 * k) for k in range(10)] + [(5, b"a" * 108, b"", 2, 7)]
    columns = [S.pa.array(c) for c in zip(*rows, strict=True)]
    for cut in ([11], [4, 7], [10, 1], [1] * 11):
        batches, at = [], 0
        for n in cut:
            batches.append(S.pa.RecordBatch.from_arrays([c.slice(at, n) for c in columns], names=["g", "ahead", "behind", "th", "pos"]))
            at += n
        found = [r for b in S._neighbours(iter(batches)) for r in b.to_pylist() if r["h"] is None]
        assert sorted((r["lo"], r["start"], r["stop"]) for r in found) == [*((1, 100 * k, 100 * k + 50) for k in range(10)), (2, 7, 57)]
