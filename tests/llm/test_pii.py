"""Base spans against the plain patterns; the field against enumeration and on consistency."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tidepool.llm import pii as P

SF = "/root/testdata/sf0.1"


def plain(s):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", s)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 13, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, s):
            d = re.sub("[^0-9]", "", m.group())
            if low <= len(d) <= high and (kind == 3 or P.luhn(d)):
                out.append((kind, *m.span()))
    return out


def test_base_spans():
    rng = random.Random(3)
    for _ in range(20_000):
        s = "".join(rng.choice("a1.@+- 2%9()b_\n") for _ in range(rng.randrange(60)))
        assert P.base_spans(s) == plain(s)
    assert P.base_spans("1" * 100_000 + "a" * 100_000 + "@") == []


@pytest.fixture(scope="module")
def model(spark):
    return P.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_belief_propagation_is_exact_on_a_chain(model):
    g = P.Graph()
    g.add(0, "+1 (017)x 555-7713 n99", [])
    assert not g.skip and len(g.chain) == 3
    x = g.arrays()[0] @ model.unary
    paths = list(itertools.product(range(P.LABELS), repeat=4))
    w = np.exp([sum(x[i, y] for i, y in enumerate(p)) + sum(model.chain[a, b] for a, b in zip(p, p[1:])) for p in paths])
    expected = np.zeros((4, P.LABELS))
    for p, v in zip(paths, w / w.sum(), strict=True):
        for i, y in enumerate(p):
            expected[i, y] += v
    assert np.allclose(P.beliefs(g, model), expected, atol=0.02)


def test_distant_mentions_agree(model):
    far = " word" * 500
    texts = [f"call +1 (017) 555-7713 now{far} or (017) 555-7713 later", f"only (017) 555-7713{far} here"]
    base = [P.base_spans(t) for t in texts]
    added = P.added_spans(texts, base, model)
    assert [texts[0][s:e] for k, s, e in added[0]] == ["(017) 555-7713"] and added[1] == []


def test_repeats_cost_a_ring():
    g = P.Graph()
    g.add(0, " x ".join(["555-771-3000"] * 2000), [])
    assert len(g.skip) == 1999


def test_odd_rows(odd, empty, odd_rows, model):
    out = P.find(odd, model)
    assert out.count() == len(odd_rows) and set(odd.columns) < set(out.columns)
    for r in out.collect():
        b = plain(r["text"] or "")
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(x[0] == k for x in b) for k in range(4)]
        text = ",".join(f"{P.KINDS[k]}:{s}:{e}" for k, s, e in sorted(b))
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(r["spans"].split(","))
    assert P.find(empty, model).count() == 0
    assert P.train(empty) is None and P.find(odd, None).count() == len(odd_rows)


def test_texts_without_base_spans_are_labelled_too(model):
    cards = "4111.1111.1111.1111 and " * 9
    texts = [cards, cards + "word " * 50 + "or a@b.cd"]
    base = [P.base_spans(t) for t in texts]
    assert base[0] == [] and [k for k, _, _ in base[1]] == [0]
    g = P.Graph()
    g.add(0, texts[0], [])
    p = P.beliefs(g, model)
    expected = [(3 - 1, s, e) for s, e, x in zip(g.start, g.end, p, strict=True) if x.argmax() == 3 and x[3] >= P.SURE]
    added = P.added_spans(texts, base, model)
    assert len(expected) >= 3 and added == [expected, expected]


def test_a_base_mention_reaches_hundreds_of_bare_ones(model):
    far = " word" * 20
    bare = f"{far} 555-7713" * 400
    for text in (f"+1 (017) 555-7713{bare} end", f"first{bare}{far} +1 (017) 555-7713"):
        base = P.base_spans(text)
        assert [k for k, _, _ in base] == [3]
        added = P.added_spans([text], [base], model)[0]
        assert [text[s:e] for k, s, e in added if k == 3] == ["555-7713"] * 400
    assert P.added_spans([f"first{bare}"], [[]], model) == [[]]


def test_messages_travel_until_they_settle():
    """Labels are passed on from token to token along a chain, exactly."""
    rng = np.random.default_rng(1)
    m = P.Model(np.zeros((P.N_FEATURES, P.LABELS)), 4 * np.eye(P.LABELS), rng.normal(size=(P.LABELS, P.LABELS)))
    g = P.Graph()
    g.add(0, " ".join(f"q{k}" for k in range(60)), [(1, 0, 2)])
    step = np.exp(m.chain) / np.exp(m.chain).sum(axis=1, keepdims=True)
    p = np.exp(P.EVIDENCE * np.eye(P.LABELS)[2])
    p = p / p.sum()
    got = P.beliefs(g, m)
    for k in range(60):
        assert np.allclose(got[k], p, atol=0.01)
        p = p @ step


def test_other_digits_and_long_parts():
    """Superscripts are no digits; leading zeros do not count."""
    text = "a 1.2.3.\u00b2 b " + "0" * 401 + "1.2.3.4 c 00000.1.2.256 \u0661.2.3.4"
    assert [text[s:e] for k, s, e in P.base_spans(text)] == ["0" * 401 + "1.2.3.4"]
    g = P.Graph()
    g.add(0, text, [])
    assert len(g.text) == 4


@pytest.mark.parametrize(("text", "added"), [
    ("call +44 20 7946 0958 now or later on 20 7946 0958 please", ["20 7946 0958"]),
    ("card 4111 1111 1111 1111 and again 4111.1111.1111.1111 ok", ["4111.1111.1111.1111"]),
    ("host 10.0.0.1 and 10-0-0-1 too", ["10-0-0-1"]),
    ("call +1 (017) 555-7713 or 555-7713 555-7713 ok", ["555-7713", "555-7713"]),
    ("order 20 7946 0958 came on 12 03 2024", []),
])
def test_rewritten_mentions(model, text, added):
    found = P.added_spans([text], [P.base_spans(text)], model)[0]
    assert [text[s:e] for _, s, e in found] == added


def test_numbers_with_spaces_are_linked():
    """Every kind: the last token of the base span to the bare number, which is one node."""
    for text in ("+44 20 7946 0958 then 20 7946 0958", "4111 1111 1111 1111 then 4111.1111.1111.1111", "+1 (017) 555-7713 then 017 555 7713"):
        g = P.Graph()
        g.add(0, text, P.base_spans(text))
        a, b = g.skip[-1]
        assert len(g.skip) == 1 and b == len(g.text) - 1 and text[g.start[b]:g.end[b]] == text.split("then ")[1] and g.label[a] >= 0


def test_belief_propagation_on_a_loopy_graph():
    """Two chains tied by skip links, against enumeration: weak potentials, where loopy messages come close."""
    rng = np.random.default_rng(2)
    m = P.Model(0.4 * rng.normal(size=(P.N_FEATURES, P.LABELS)), 0.3 * rng.normal(size=(P.LABELS, P.LABELS)), 0.5 * np.eye(P.LABELS))
    g = P.Graph()
    g.add(0, "x55512347 q2 word 555-12347 q3 word x55512347", [])
    assert len(g.text) == 5 and len(g.skip) == 2 and len(g.chain) == 2
    x = g.arrays()[0] @ m.unary
    expected = np.zeros((5, P.LABELS))
    for p in itertools.product(range(P.LABELS), repeat=5):
        v = np.exp(sum(x[i, y] for i, y in enumerate(p)) + sum(m.chain[p[a], p[b]] for a, b in g.chain) + sum(m.skip[p[a], p[b]] for a, b in g.skip))
        for i, y in enumerate(p):
            expected[i, y] += v
    expected /= expected.sum(axis=1, keepdims=True)
    assert np.allclose(P.beliefs(g, m), expected, atol=0.03)
