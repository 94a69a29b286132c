"""CRF language ID: inference against enumeration, held-out accuracy, odd rows."""

import itertools
import zlib

import numpy as np
import pytest

from tidepool.llm import langid as L

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("size", [1, 2, 3, 64])
def test_forward_backward_is_exact(monkeypatch, size):
    monkeypatch.setattr(L, "RUN", size)
    rng = np.random.default_rng(0)
    em, t, s = rng.normal(size=(6, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    g, pairs, begun = L.forward_backward(em, L._runs(np.array([0, 0, 0, 0, 1, 1]), np.array([4, 2])), t, s, learn=True)
    expected, joint = np.zeros((6, 3)), np.zeros((3, 3))
    for words in ([0, 1, 2, 3], [4, 5]):
        paths = list(itertools.product(range(3), repeat=len(words)))
        w = np.exp([s[p[0]] + sum(em[i, y] for i, y in zip(words, p, strict=True)) + sum(t[a, b] for a, b in zip(p, p[1:]))
                    for p in paths])
        for p, x in zip(paths, w / w.sum(), strict=True):
            for i, y in zip(words, p, strict=True):
                expected[i, y] += x
            for a, b in zip(p, p[1:]):
                joint[a, b] += x
    assert np.allclose(g, expected) and np.allclose(pairs, joint) and np.allclose(begun, expected[0] + expected[4])


def test_a_long_chain_is_one(monkeypatch):
    """10,000 words, evidence only at the ends: runs of 64 as one word after the other."""
    rng = np.random.default_rng(1)
    em, t, s = rng.normal(size=(10_000, 3)) * 0.01, np.diag([9.0, 9.0, 9.0]), rng.normal(size=3)
    em[5], em[9_000] = [4, 0, 0], [0, 0, 4]
    doc, counts = np.zeros(10_000, np.int64), np.array([10_000])
    a = np.zeros((10_000, 3))
    b = np.ones((10_000, 3))
    for i in range(10_000):
        a[i] = (np.exp(s) if i == 0 else a[i - 1] @ np.exp(t)) * np.exp(em[i])
        a[i] /= a[i].sum()
    for i in range(9_998, -1, -1):
        b[i] = np.exp(t) @ (np.exp(em[i + 1]) * b[i + 1])
        b[i] /= b[i].sum()
    expected = a * b / (a * b).sum(axis=1, keepdims=True)
    got = L.forward_backward(em, L._runs(doc, counts), t, s)[0]
    assert np.allclose(got, expected)
    assert got[100, 0] > got[3_000, 0] > got[8_990, 0] + 0.1  # evidence crosses many runs


@pytest.fixture(scope="module")
def trained(spark):
    return L.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark, trained):
    rows = L.identify(spark.read.parquet(f"{SF}/documents.parquet"), trained).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97


def test_switches_inside_a_text(trained):
    texts = [b"the and of that in was for with " * 4 + "la que los ción mente del las por ".encode() * 4]
    _, g = L.label_words(texts, trained)
    named = [trained.langs[i] for i in g.argmax(axis=1)]
    assert named[:30].count("en") >= 28 and named[-30:].count("es") >= 28


def test_odd_rows(odd, empty, odd_rows, trained):
    out = L.identify(odd, trained)
    assert set(out.columns) == {*odd.columns, "lang_pred"} and out.count() == len(odd_rows)
    for r in out.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert L.identify(empty, trained).count() == 0


def test_without_labels(odd, empty):
    assert {r["lang_pred"] for r in L.identify(odd, L.train(empty)).collect()} == {"und"}


def test_every_language_is_learned(spark):
    # seventy languages of three words each, and one of long texts only
    words = [[f"{a}{b}{c}" for c in ("ki", "lo", "mu")] for a in "bcdfghjkmn" for b in ("aba", "ebe", "ibi", "obo", "ubu", "aza", "ozo")]
    rows = [(100 * k + j, " ".join(ws * (3 + j)), f"x{k:02d}") for k, ws in enumerate(words) for j in range(8 if k else 5)]
    rows += [(100_000 + j, "wyrd wolf weald " * 400, "zz") for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    m = L.train(docs)
    assert sorted(m.langs) == [f"x{k:02d}" for k in range(70)] + ["zz"]
    tests = spark.createDataFrame([(1, "wyrd weald wolf"), (2, " ".join(words[0] * 2)), (3, " ".join(words[69] * 2))], "doc_id bigint, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in L.identify(tests, m).collect()} == {1: "zz", 2: "x00", 3: "x69"}
