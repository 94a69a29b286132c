"""Jaccard join against all pairs in plain Python; its bounds and its tree."""

import itertools
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import prose
from tidepool.llm import components as CC
from tidepool.llm import jaccard_join as J
from tidepool.llm.textvec import pieces, text_bytes, text_pieces


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids and sets[k] else i))
    return sorted(out, key=str)


def near_rows():
    """A chain of near copies, a large group of them, a passage that many share, and strangers."""
    rng = random.Random(9)
    rows, ws = [], prose(rng, 120).split()
    for i in range(8):  # each links with the next, the ends do not link
        rows.append((100 + i, " ".join(ws)))
        ws = ws[:10 * i] + prose(rng, 4).split() + ws[10 * i + 4:]
    base = prose(rng, 150).split()
    for i in range(60):
        k = rng.randrange(150)
        rows.append((200 + i, " ".join(base[:k] + ["changed%d" % i] + base[k + 1:])))
    passage = prose(rng, 40)
    rows += [(300 + i, f"{prose(rng, 25)} {passage} {prose(rng, rng.randrange(5, 60))}") for i in range(40)]
    rows += [(400 + i, passage + " " + prose(rng, 2)) for i in range(6)]
    return rows


def test_against_all_pairs(spark, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows] + near_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n int, h string").repartition(4)
    expected = brute(rows)
    assert sorted(map(tuple, J.classes(df).collect()), key=str) == expected
    kept = J.drop_near_copies(df)
    assert kept.columns == df.columns
    assert {r[0] for r in kept.collect()} == {i for i, _, c in expected if i == c}


def test_empty(empty):
    assert J.classes(empty).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_all_that_the_bound_allows(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(20, 90, 150)
    points = [np.bincount(rng.integers(0, w, k), minlength=w) for k, w in zip(n, rng.choice([16, 32], 150), strict=True)]
    points[7], n[7] = points[3], n[3]
    tree = J.RTree(n.astype(np.int64), points)
    for i in range(0, 150, 7):
        expected = {j for j in range(150) if J.may_link(int(n[i]), points[i], int(n[j]), points[j])}
        assert expected <= {k for k, _ in tree.search(int(n[i]), points[i])}


def test_bound_never_hides_a_link():
    rng = random.Random(1)
    for _ in range(200):
        a = prose(rng, rng.randrange(8, 60)).split()
        b = list(a)
        b[rng.randrange(len(b))] = "other"
        texts = [" ".join(a).encode(), " ".join(b).encode()]
        doc, h = J.shingle_sets(texts)
        n = np.bincount(doc, minlength=2)
        p = [np.frombuffer(x, "<u2").astype(np.int64) for x in J._points(doc, h, n)]
        both = len(set(h[doc == 0]) & set(h[doc == 1]))
        if 100 * both >= 75 * (n.sum() - both):
            assert J.may_link(int(n[0]), p[0], int(n[1]), p[1])


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 5000), (5000, 70), (9, 9)]
    got = {r["node"]: r["component"] for r in CC.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 70, 5000: 70, 70: 70}
    assert CC.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_points_travel_coded(spark):
    rng = random.Random(5)
    texts = [prose(rng, k) for k in (40, 300, 900)] + ["", "a b c d e " * 400]
    doc, h = J.shingle_sets([t.encode() for t in texts])
    n = np.bincount(doc, minlength=len(texts))
    plain = J._points(doc, h, n)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"]: bytes(r["point"]) for r in J._survey(docs).where("set_id is not null").collect()}
    assert [J.decoded(kept[i]) for i in range(len(texts))] == plain
    assert sum(map(len, kept.values())) < 0.7 * sum(map(len, plain))


def test_survey_counts_repeated_shingles(spark):
    texts = [(0, "a b c d e f g"), (1, "a b c d e f"), (2, "x y z"), (3, None), (4, "X y Z"), (5, "b c d e f")]
    found = [r["c"] for r in J._survey(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).where("h is not null").collect()]
    own = Counter(s for _, t in texts for s in shingles(t))
    assert sorted(found) == sorted(c for c in own.values() if c > 1) == [2, 2, 3]


def test_survey_holds_one_piece_of_texts():
    """A task's memory beside its batch is that of a piece of texts, not of the batch."""
    run = []

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, f, schema):
            run.append(f)

    J._survey(Docs())
    text = "w" * 4_000  # one word: all that grows is the texts
    batch = pa.RecordBatch.from_arrays([pa.array(range(6_000)), pa.array([text] * 6_000)], names=["doc_id", "text"])
    list(run[0](iter([batch.slice(0, 300)])))
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    rows, most = 0, 0
    for out in run[0](iter([batch])):
        rows += out.num_rows
        most = max(most, tracemalloc.get_traced_memory()[0] - before)
        del out
    tracemalloc.stop()
    assert rows >= 6_000 and most < 12_000_000  # the batch holds 24 MB of text


@pytest.mark.parametrize("size", [1, 7, 20, 1 << 20])
def test_text_pieces(size):
    column = pa.array([None, "", "abc", "é" * 9, None, "x", "yy", "z" * 30, ""])
    for part in (column, column.slice(3, 4), column.slice(0, 0), column.cast(pa.large_string())):
        own = [(k, [t or b"" for t in texts]) for k, texts in pieces(text_bytes(part), size)]
        assert list(text_pieces(part, size)) == own


def _sets_of(rng, n):
    """Sets of shared and own shingles in one order, near copies among them."""
    out = []
    for k in range(n):
        own = rng.sample(range(1_000 * k + 100, 1_000 * k + 400), rng.randrange(6, 120))
        out.append({*own, *rng.sample(range(30), rng.randrange(12))})
        if k % 3 == 0:
            out.append({x for x in out[-1] if rng.random() < 0.93} | {x + 500 for x in own[:rng.randrange(1, 4)]})
    return [sorted(x, key=lambda v: (v * 7_919 % 10_007, v)) for x in out]


def _cells(sets):
    rows = sorted((x, s, int(J._sizes(np.int64(len(v)), np.int64(p)))) for s, v in enumerate(sets) for p, x in enumerate(v) if p <= len(v) // 4)
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["h", "set_id", "sizes"])


def _groups(batches):
    out = {}
    for b in J._cell_members(iter(batches)):
        for c, s in zip(*[b.column(k).to_pylist() for k in (0, 1)], strict=True):
            out.setdefault(c, set()).add(s)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_cells_keep_every_link(seed):
    sets = _sets_of(random.Random(seed), 60)
    cells = _cells(sets)
    links = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
             if 7 * len(set(sets[a]) & set(sets[b])) >= 3 * (len(sets[a]) + len(sets[b]))]
    assert len(links) > 5
    for step in (1, 2, 5, 64, 10_000):
        found = _groups(cells.slice(k, step) for k in range(0, cells.num_rows, step))
        assert all(any({a, b} <= g for g in found.values()) for a, b in links), step
    found = _groups([cells])
    assert sum(map(len, found.values())) < 0.7 * sum(map(len, _groups(cells.slice(k, 1) for k in range(cells.num_rows)).values()))


def test_cells_leave_out_sets_of_unlike_sizes():
    """A shingle that sets of unlike sizes, or far down their order, have in common makes them no group."""
    n = np.array([40, 60, 90, 140, 50, 50, 50, 48, 9, 9])
    place = np.array([0, 0, 0, 0, 11, 12, 0, 1, 0, 0])
    h = [1, 1, 1, 1, 2, 2, 3, 3, 4, 5]
    b = pa.RecordBatch.from_arrays([pa.array(h), pa.array(range(10)), pa.array(J._sizes(n, place))], names=["h", "set_id", "sizes"])
    first, last = (pa.RecordBatch.from_arrays([pa.array([x]), pa.array([x]), pa.array([0])], names=b.schema.names) for x in (0, 99))
    assert _groups([pa.Table.from_batches([first, b, last]).combine_chunks().to_batches()[0]]) == {6: {6, 7}}


@pytest.mark.parametrize("most", [2, 3, 64])
def test_mates_against_all_pairs(monkeypatch, most):
    monkeypatch.setattr(J, "CELL", most)
    rng = np.random.default_rng(most)
    h = np.sort(rng.integers(0, 60, 250))
    n = rng.integers(8, 40, 250)
    sizes = J._sizes(n, rng.integers(0, n // 4 + 1))
    limit = sizes & 0xFFFFFFFF
    expected = [Counter(h.tolist())[x] > most or any(h[j] == x and j != i and n[i] <= limit[j] and n[j] <= limit[i] for j in range(250))
                for i, x in enumerate(h)]
    assert J._mates(h, sizes).tolist() == expected
    assert J._mates(h[:0], sizes[:0]).tolist() == [] and J._mates(h[:1], sizes[:1]).tolist() == [False]


def test_frequent_does_not_depend_on_the_number_of_documents(spark, monkeypatch):
    """A shingle of a few documents among very many is frequent where there are no more frequent ones."""
    counts = {k: 3 + k // 2 for k in range(-20, 60) if k >= 0} | {-5: 1_000_000, -6: 2, -7: 1}
    rows = [(h, c) for h, c in counts.items()] + [(None, None)] * 10_000
    survey = spark.createDataFrame(rows, "h bigint, c bigint")
    hot, level = J._frequent(survey)
    assert hot.view(np.int64).tolist() == [*range(60), -5] and hot.tolist() == sorted(hot.tolist())
    assert all(a <= b for a, b in itertools.pairwise(level.tolist())) and level[0] > 0
    monkeypatch.setattr(J, "HOT_MOST", 4)
    assert J._frequent(survey)[0].view(np.int64).tolist() == [56, 58, 59, -5]


def test_a_passage_in_texts_of_unlike_sizes_makes_no_groups(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        passage = prose(rng, 12)
        rows += [(2 * i, f"{passage} {prose(rng, 30)}"), (2 * i + 1, f"{prose(rng, 60)} {passage} {prose(rng, 20)}")]
    groups = []

    def saved(df):
        out = plain(df)
        if out.columns == ["center", "set_id"]:
            groups.append(out.count())
        return out

    plain = J.saved
    monkeypatch.setattr(J, "saved", saved)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, J.classes(docs).collect())) == sorted(brute(rows))
    assert len(groups) == 1 and groups[0] < 20  # the last cell of a task is kept as it is; 72 rows without the sizes
