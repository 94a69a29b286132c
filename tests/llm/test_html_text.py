"""Block labeller: block cutting, held-out agreement with marked pages, odd rows."""

import zlib

import numpy as np
import pytest

from tidepool.llm import html_text as H

SF = "/root/testdata/sf0.1"


def test_blocks():
    page = ("<!DOCTYPE html><title>T &amp; t</title><script>var a='<p>no</p>'</script><p>one <b>b</b>old<br>x<p class='Big Note'>"
            "two&nbsp;&lt;3<!-- <p>no --><ul><li><a href='>'>link</a> tail<li>last</ul><style>p{}</style>1 < 2</div>end<!-- open")
    bs = H.blocks(page)
    assert [b.text for b in bs] == ["T & t", "one bold x", "two <3", "link tail", "last", "1 < 2", "end"]
    assert bs[2].path == ("<p", ".big", ".note") and bs[3].linked == 4 and bs[4].path == ("<ul", "<li")
    assert H.blocks("") == [] and H.blocks("<script>x") == [] and H.blocks("<" * 1000)[0].text == "<" * 1000


@pytest.fixture(scope="module")
def model(spark):
    return H.train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_held_out_pages(spark, model):
    rows = [r for r in H.extract(spark.read.parquet(f"{SF}/pages.parquet"), model).collect()
            if zlib.crc32(str(r["page_id"]).encode()) % 5 == 0]
    right = [r["text"] == " ".join(b.text for b, y in zip(bs, H.teacher(bs), strict=True) if y)
             for r in rows for bs in [H.blocks(r["html"])]]
    assert np.mean(right) > 0.98 and all(r["n_chars"] == len(r["text"]) for r in rows)


def test_unmarked_containers(model):
    page = ("<body><div class='menu'><ul><li><a>Home</a><li><a>News</a></ul></div><div class='content'><h1>A day out</h1>"
            "<p>They went along the road and came back.</p><p>It was late when they did.</p></div>"
            "<div class='comments'><p>what a nice day you had</p></div><form><label>Your mail</label></form>"
            "<footer>all rights</footer></body>")
    assert H.main_texts([page], model) == ["A day out They went along the road and came back. It was late when they did."]


def test_gradient():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=(4, 2, 3)), rng.normal(0, 0.5, (3 + H.HIDDEN + 1, 4 * H.HIDDEN))
    mask, d = np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float), rng.normal(size=(4, 2, H.HIDDEN))
    hs, kept = H._lstm(x, mask, w)
    grad = H._lstm_back(x, kept, d, w)
    for at in ((0, 1), (5, 30), (23, 70), (2, 45)):
        up, down = w.copy(), w.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        num = ((H._lstm(x, mask, up)[0] - H._lstm(x, mask, down)[0]) * d).sum() / 2e-5
        assert abs(num - grad[at]) < 1e-4


def test_odd_rows(spark, model):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (2, None, "", "t"), (None, "u", "<p>", "t"), (3, "u", "plain words only", "t"),
            (4, "u", "<article>" + "<p>again and again</p>" * 5000 + "</article>", "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = H.extract(df, model).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    assert [r["text"] for r in out if not r["html"]] == ["", "", ""]
    assert H.extract(df.limit(0), model).count() == 0
    assert H.train(df.limit(0)) is not None


def test_deep_pages_keep_their_ancestors():
    deep = "<div class='c'>" * 100 + "<section class='comments'><blockquote>inner</blockquote></section>" + "</div>" * 100
    bs = H.blocks(f"<body><div><article><p>before</p>{deep}<p>after</p></article><p>outside</p></div>")
    assert [b.text for b in bs] == ["before", "inner", "after", "outside"]
    assert bs[2].path == bs[0].path == ("<body", "<div", "<article", "<p") and bs[3].path == ("<body", "<div", "<p")
    assert {".comments", "<section", "<article"} <= set(bs[1].path) and bs[1].path[-1] == "<blockquote"
    below = H.blocks("<div>" * 200 + "<article><p>low</p></article><p>next</p>")
    assert H.teacher(below).tolist() == [1, 0]


def test_every_word_of_a_class_counts():
    words = " ".join(f"w{'abcdefghij'[k // 10]}{'abcdefghij'[k % 10]}" for k in range(40))
    b = H.blocks(f"<article><div class='{words} comments'>text</div></article>")
    assert H.teacher(b).tolist() == [0]
    every = H.Block(("<article", "<div", *("." + w for w in words.split()), ".comments"), "text", 0)
    assert np.array_equal(H.vectors(b), H.vectors([every]))


def test_very_deep_page_takes_linear_time():
    page = "".join(f"<div class='x{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}'>t{k}</em></b></ul>" for k in range(20_000))
    assert len(H.blocks(page)) > 19_000


def test_training_reads_pieces_of_long_pages(spark, monkeypatch):
    head = "<html><head><style>" + "p { } " * 8000 + "</style></head><body><article>"
    rows = [(k, f"{head}<p>the main words of {k}</p>" + "<p>more of it</p>" * 3000 + "</article>") for k in range(20)]
    seen = []
    monkeypatch.setattr(H, "fit", seen.extend)
    H.train(spark.createDataFrame(rows, "page_id bigint, html string"))
    assert seen and all(len(p) <= H.SAMPLE_CHARS and H.teacher(H.blocks(p)).any() for p in seen)


def test_self_closed_svg_and_marks_in_quotes():
    texts = lambda page: [b.text for b in H.blocks(page)]
    assert texts("<p>a</p><svg/><p>b</p><svg width='1' /><p>c<svg><path d='x'/>no</svg>d") == ["a", "b", "cd"]
    assert texts('<p data-x="a < b > c">one<p title=\'<b>\'>two<img alt="1 < 2" src=a>three') == ["one", "twothree"]
    assert texts('<p title="stray>one</p><p>two</p>' + "x" * 5000 + "<b>") != []
    assert texts('<a "' * 20_000 + "end")[-1].endswith("end")


def test_long_pages_are_read_in_steps(model, monkeypatch):
    """States are carried on: any number of steps gives the probabilities of the whole page at once."""
    rng = np.random.default_rng(0)
    page = lambda n: [H.Block(("<html", "<body", *([("<article", "<p")][0] if rng.random() < 0.5 else ("<div", ".menu"))),
                              " ".join(rng.choice(["the", "of", "more.", "x"], 6)), 0) for _ in range(n)]
    pages = [page(50), page(3), page(17)]
    whole = H.probabilities(pages, model)
    for steps in (1, 7, 49):
        monkeypatch.setattr(H, "STEPS", steps)
        for a, b in zip(H.probabilities(pages, model), whole, strict=True):
            assert np.allclose(a, b, atol=1e-4)
