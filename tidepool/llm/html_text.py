"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: runs of text between block-level tags, with
the path of open tags (names, classes, ids) above them.  Each block becomes a
vector of hashed path elements, hashed words and a few lengths; a bidirectional
LSTM in numpy reads the page's whole sequence of blocks and classifies each one
with the context of the entire page.  Blocks of the main text are joined.

The labeller is trained on at most ``SAMPLE`` pages (of at most
``SAMPLE_CHARS`` code points, or pieces around the mark of longer ones where
there are too few) that mark their article themselves (``<article>``,
``<main>``), and on variations of them: the container under
other names, and added menus, notices, adverts, forms, side bars and comments.
Path elements are hidden at random while training, so no single mark decides.
Where no page marks its article, variations built from plain words alone serve.

Defined results: null and empty html, and pages without a main block, give the
empty text and 0; unclosed tags reach to the next tag that ends them or to the
end; an unclosed comment, script or style reaches to the end; character
references are decoded, white space of a block becomes one space; repeated rows
get equal results; other columns are carried along (``text`` and ``n_chars``
are replaced); an empty table stays empty.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tidepool.llm.sampling import bounded_sample
from tidepool.llm.textvec import append_columns

SAMPLE, SAMPLE_CHARS = 300, 20_000
PATH, WORDS, NUMBERS, HIDDEN = 160, 48, 6, 20
EPOCHS, RATE, HIDE = 20, 0.01, 0.1
#: Blocks that are labelled together.
TOGETHER = 16_384
#: Blocks of a page that are worked on at once.
STEPS = 4_096
#: Words of an attribute, and depth of open tags, up to which all elements are kept as they are.
FEW, DEEP = 8, 64

_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd label mark q s samp small span "
                    "strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(("script", "style", "noscript", "template", "textarea", "iframe", "svg"))
#: Tags that a following tag of the same group closes.
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
#: A tag's attributes may hold < and > in quotes; a quote that is not closed within 4,096 characters of which one is < is a stray one.
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\"<>]++|\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]{0,4096}+\"|'[^']{0,4096}+'|['\"])*+)>", re.S)
_ATTR = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NAMES = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int  # code points inside links


@lru_cache(maxsize=20_000)
def _elements(name: str, attrs: str) -> tuple[str, ...]:
    """Path elements of a tag: its name, and the words of its class, id and role.
    Of many words, those that make no difference to vector or teacher are left out."""
    out = ["<" + name]
    for _, value in _ATTR.findall(attrs):
        words = ["." + x for x in _NAMES.findall(value.lower())]
        if len(words) > FEW:
            told: dict[int, str] = {}
            words = list(dict.fromkeys(_telling(x, told) for x in words))
        out += words
    return tuple(out)


def _telling(element: str, told: dict[int, str]) -> str:
    """The element itself where the teacher knows it, else the first one seen of its slot in the vector."""
    return element if element in _MAIN or element in _SIDE else told.setdefault(_slot(element, PATH), element)


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    state = {"link": False, "linked": 0}
    opened: Counter[str] = Counter()  # open tags by name
    # elements of the open tags beyond the depth DEEP, those of a slot as one, so that deep pages take linear time
    deep: Counter[str] = Counter()
    told: dict[int, str] = {}

    def push(name: str, elements: tuple[str, ...]) -> None:
        stack.append((name, elements))
        opened[name] += 1
        if len(stack) > DEEP:
            deep.update(_telling(e, told) for e in elements)

    def pop() -> str:
        beyond = len(stack) > DEEP
        name, elements = stack.pop()
        opened[name] -= 1
        if beyond:
            for e in elements:
                e = _telling(e, told)
                deep[e] -= 1
                if not deep[e]:
                    del deep[e]
        return name

    def text(piece: str) -> None:
        if piece:
            piece = entities.unescape(piece)
            held.append(piece)
            if state["link"]:
                state["linked"] += len(piece)

    def flush() -> None:
        if held:
            s = " ".join("".join(held).split())
            if s:
                path = tuple(e for _, es in stack[:DEEP] for e in es)
                if len(stack) > DEEP:
                    path += (*deep, *stack[-1][1])
                out.append(Block(path, s, state["linked"]))
        held.clear()
        state["linked"] = 0

    at, end = 0, len(page)
    while at < end:
        m = _MARK.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        closing = bool(m.group(1))
        if name == "svg" and m.group(3).endswith("/"):
            continue  # closes itself
        if name in _RAW and not closing:
            close = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in _INLINE:
            if name == "br":
                held.append(" ")
            elif name == "a":
                state["link"] = not closing
            continue
        flush()
        if closing:
            if opened[name]:
                while pop() != name:
                    pass
        elif name not in _VOID:
            if name in _CLOSES and stack and stack[-1][0] in _CLOSES[name]:
                pop()
            elif stack and stack[-1][0] == "p":
                pop()  # a block-level tag ends a paragraph
            push(name, _elements(name, m.group(3)))
    flush()
    return out


@lru_cache(maxsize=50_000)
def _slot(s: str, n: int) -> int:
    return zlib.crc32(s.encode()) % n


def vectors(page: list[Block], first: int = 0, last: int | None = None) -> np.ndarray:
    """One row per block (of those from ``first`` to before ``last``): hashed path, hashed words, lengths."""
    part = page[first:last]
    x = np.zeros((len(part), PATH + WORDS + NUMBERS), np.float32)
    for i, b in enumerate(part):
        for e in b.path:
            x[i, _slot(e, PATH)] = 1
        if b.path:
            last = next(e for e in reversed(b.path) if e[0] == "<")
            x[i, _slot("last" + last, PATH)] = 1
        ws = b.text.lower().split()
        slots = np.bincount([zlib.crc32(w.encode()) % WORDS for w in ws], minlength=WORDS)
        x[i, PATH:PATH + WORDS] = slots / np.sqrt(len(ws))
        x[i, PATH + WORDS:] = (np.log1p(len(b.text)) / 5, min(b.linked / len(b.text), 1.0), b.text[-1] in ".!?",
                               min(first + i, 8) / 8, min(len(page) - first - i, 8) / 8, 1.0)
    return x


@dataclass
class Model:
    """Weights of both directions (input + hidden + 1 rows, 4 gates) and of the output."""

    w: list[np.ndarray]
    out: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, state: tuple | None = None, learn: bool = True) -> tuple[np.ndarray, list | tuple]:
    """Hidden states over time of x (time, batch, input) from ``state`` on, and
    what the backward pass needs or, where nothing is learned, the last state."""
    steps, batch, _ = x.shape
    h, c = state or (np.zeros((batch, HIDDEN), x.dtype), np.zeros((batch, HIDDEN), x.dtype))
    inner = x.reshape(steps * batch, -1) @ w[:x.shape[2]] + w[-1]
    inner = inner.reshape(steps, batch, -1)
    wh = w[x.shape[2]:-1]
    hs, kept = np.zeros((steps, batch, HIDDEN), x.dtype), []
    for t in range(steps):
        z = inner[t] + h @ wh
        s = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        c_new = (f * c + i * g) * m
        tc = np.tanh(c_new)
        h_new = o * tc * m
        if learn:
            kept.append((i, f, o, g, c, tc, h, m))
        h, c = h_new, c_new
        hs[t] = h
    return hs, kept if learn else (h, c)


def _lstm_back(x: np.ndarray, kept: list, dhs: np.ndarray, w: np.ndarray) -> np.ndarray:
    steps, batch, d = x.shape
    dh, dc = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
    wh = w[d:-1]
    dz_all, h_all = np.zeros((steps, batch, 4 * HIDDEN)), np.zeros((steps, batch, HIDDEN))
    for t in range(steps - 1, -1, -1):
        i, f, o, g, c, tc, h, m = kept[t]
        dh = (dh + dhs[t]) * m
        dct = (dc + dh * o * (1 - tc * tc)) * m
        dz = np.concatenate([dct * g * i * (1 - i), dct * c * f * (1 - f), dh * tc * o * (1 - o), dct * i * (1 - g * g)], axis=1)
        dz_all[t], h_all[t] = dz, h
        dh, dc = dz @ wh.T, dct * f
    flat = dz_all.reshape(steps * batch, -1)
    return np.vstack([x.reshape(steps * batch, d).T @ flat, h_all.reshape(steps * batch, -1).T @ flat, flat.sum(axis=0)])


def _padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences forward and each reversed in place (time, batch, input), and the mask."""
    steps = max(len(s) for s in seqs)
    x = np.zeros((steps, len(seqs), seqs[0].shape[1]), np.float32)
    r, mask = np.zeros_like(x), np.zeros((steps, len(seqs)), np.float32)
    for b, s in enumerate(seqs):
        x[:len(s), b], r[:len(s), b], mask[:len(s), b] = s, s[::-1], 1
    return x, r, mask


def _turned(a: np.ndarray, lens: list[int]) -> np.ndarray:
    """The reversed direction's states, back in page order."""
    out = np.zeros_like(a)
    for b, n in enumerate(lens):
        out[:n, b] = a[:n, b][::-1]
    return out


def _states(pages: list[list[Block]], w: np.ndarray, reverse: bool) -> np.ndarray:
    """Hidden states of a direction over time, STEPS blocks at a time with the
    state carried on, so that what is held of a page of any length is its states."""
    lens = [len(p) for p in pages]
    out, state = np.zeros((max(lens), len(pages), HIDDEN), np.float32), None
    for t in range(0, max(lens), STEPS):
        n = min(STEPS, max(lens) - t)
        x, mask = np.zeros((n, len(pages), PATH + WORDS + NUMBERS), np.float32), np.zeros((n, len(pages)), np.float32)
        for b, (page, size) in enumerate(zip(pages, lens)):
            here = min(n, size - t)
            if here > 0:
                x[:here, b] = vectors(page, size - t - here, size - t)[::-1] if reverse else vectors(page, t, t + here)
                mask[:here, b] = 1
        out[t:t + n], state = _lstm(x, mask, w, state, learn=False)
    return out


def probabilities(pages: list[list[Block]], m: Model) -> list[np.ndarray]:
    """Probability of main text of each block of each page."""
    lens = [len(p) for p in pages]
    if max(lens) <= STEPS:  # the vectors serve both directions
        x, r, mask = _padded([vectors(p) for p in pages])
        fwd, bwd = (_lstm(a, mask, w, learn=False)[0] for a, w in ((x, m.w[0]), (r, m.w[1])))
    else:
        fwd, bwd = (_states(pages, w, reverse) for w, reverse in zip(m.w, (False, True)))
    both = np.concatenate([fwd, _turned(bwd, lens)], axis=2)
    p = _sigmoid(both @ m.out[:-1] + m.out[-1])
    return [p[:n, b] for b, n in enumerate(lens)]


_MAIN = frozenset(("<article", "<main"))
_SIDE = frozenset(("<nav", "<footer", "<aside", "<form", "<header", "<head", "<button", "<select", ".ad", ".ads", ".advert",
                   ".banner", ".comment", ".comments", ".cookie", ".notice", ".sidebar", ".menu", ".promo", ".share",
                   ".related", ".newsletter", ".popup", ".subscribe", ".breadcrumb", ".sponsored", ".reply", ".discussion"))


def teacher(page: list[Block]) -> np.ndarray:
    """Labels of a page that marks its article."""
    return np.array([bool(_MAIN & set(b.path)) and not _SIDE & set(b.path) for b in page], np.float32)


_PLAIN = ("It was a long day and the road went on to the hills.", "They came back with what they had found there.",
          "No one had seen the old house since the summer.", "Read more", "All about it", "The end of the story is not known yet.")


def _variation(rng: np.random.Generator, main: list[str], other: list[str]) -> tuple[list[Block], list[float]]:
    """A made-up page around paragraphs ``main``, with side blocks of ``other`` words."""

    def some(least: int, most: int) -> str:
        ws = other[rng.integers(len(other))].split()
        n = int(rng.integers(least, most + 1))
        at = int(rng.integers(max(len(ws) - n, 0) + 1))
        return " ".join(ws[at:at + n]) or "more"

    def side(names: tuple[str, ...], path: tuple[str, ...], count: int, words: tuple[int, int], linked: bool) -> list:
        return [(Block((*path, *names), t, len(t) if linked else 0), 0.0) for t in (some(*words) for _ in range(count))]

    root = ("<html", "<body")
    pick = lambda *xs: xs[rng.integers(len(xs))]
    wrap = (*root, *pick((), ("<div", ".wrapper"), ("<div", ".page"), ("<div", ".container")))
    holder = pick(("<article",), ("<main",), ("<main", "<article"), ("<div", ".content"), ("<div", ".post"), ("<div", ".article"),
                  ("<div", ".entry", ".content"), ("<section", ".story"), ("<div", ".main"))
    rows: list = [(Block(("<html", "<head", "<title"), main[0][:80], 0), 0.0)]
    top = [side(("<nav", "<ul", "<li"), wrap, int(rng.integers(3, 8)), (1, 2), True),
           side(pick(("<header", "<p"), ("<header", "<div", ".logo"), ("<div", ".header")), wrap, 1, (1, 8), False),
           side(pick(("<div", ".cookie", ".notice"), ("<div", ".notice"), ("<div", ".banner", "<p"), ("<div", ".alert")), wrap, 1, (4, 25), False),
           side(pick(("<div", ".ad"), ("<div", ".advert"), ("<div", ".ads", "<p"), ("<aside", ".sponsored")), wrap, 1, (3, 25), False),
           side(("<ul", ".menu", "<li"), wrap, int(rng.integers(3, 7)), (1, 3), True)]
    rows += [r for part in top if rng.random() < 0.5 for r in part]
    rows.append((Block((*wrap, *holder, pick("<h1", "<h2")), main[0][:120], 0), 1.0))
    for t in main:
        rows.append((Block((*wrap, *holder, pick("<p", "<p", "<p", "<li", "<blockquote", "<h2", "<td")), t, 0), 1.0))
        if rng.random() < 0.15:
            rows += side(pick(("<div", ".ad"), ("<div", ".advert", "<p"), ("<aside", "<p"), ("<div", ".share"), ("<form", "<p"),
                              ("<div", ".newsletter", "<p")), (*wrap, *holder), 1, (2, 25), False)
    low = [side(pick(("<div", ".comments", "<p"), ("<section", ".comments", "<div", ".comment", "<p"), ("<div", ".comment"),
                     ("<ul", ".comments", "<li")), pick(wrap, (*wrap, *holder)), int(rng.integers(1, 5)), (4, 40), False),
           side(pick(("<aside", "<p"), ("<div", ".sidebar", "<p"), ("<aside", ".sidebar", "<ul", "<li")), wrap, int(rng.integers(1, 4)), (2, 25), False),
           side(pick(("<form", "<label"), ("<form", "<p"), ("<div", ".subscribe", "<form")), wrap, 1, (2, 10), False),
           side(("<div", ".related", "<ul", "<li"), wrap, int(rng.integers(2, 5)), (3, 9), True)]
    rows += [r for part in low if rng.random() < 0.4 for r in part]
    rows += side(pick(("<footer",), ("<footer", "<p"), ("<div", ".footer")), wrap, 1, (3, 25), False)
    return [b for b, _ in rows], [y for _, y in rows]


def fit(pages: list[str]) -> Model:
    """Backpropagation through time with adaptive steps over marked pages and their variations."""
    rng = np.random.default_rng(11)
    seqs, ys = [], []
    mains, others = [], list(_PLAIN)
    for p in pages:
        bs = blocks(p)
        y = teacher(bs)
        if y.any():
            seqs.append(vectors(bs))
            ys.append(y)
            mains.append([b.text for b, k in zip(bs, y, strict=True) if k][:12])
            others += [b.text for b, k in zip(bs, y, strict=True) if not k and len(b.text) > 20]
            others.append(mains[-1][-1])
    for k in range(max(len(mains), 120)):
        bs, y = _variation(rng, mains[k % len(mains)] if mains else [_PLAIN[(k + j) % len(_PLAIN)] for j in range(3)], others)
        seqs.append(vectors(bs))
        ys.append(np.array(y, np.float32))
    d = seqs[0].shape[1]
    params = [rng.normal(0, 0.1, (d + HIDDEN + 1, 4 * HIDDEN)), rng.normal(0, 0.1, (d + HIDDEN + 1, 4 * HIDDEN)),
              rng.normal(0, 0.1, 2 * HIDDEN + 1)]
    for w in params[:2]:
        w[-1, HIDDEN:2 * HIDDEN] = 1  # remember at first
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = np.argsort([len(s) + rng.random() * 8 for s in seqs])
        for part in rng.permutation(np.array_split(order, max(len(order) // 24, 1)).__len__()):
            ids = np.array_split(order, max(len(order) // 24, 1))[part]
            batch = []
            for i in ids:
                s = seqs[i].copy()
                s[:, :PATH] *= rng.random(PATH) >= HIDE
                s[:, PATH:] *= rng.random() >= 0.3  # some pages by their paths alone
                batch.append(s)
            x, r, mask = _padded(batch)
            lens = [len(s) for s in batch]
            y = np.zeros(mask.shape, np.float32)
            for b, i in enumerate(ids):
                y[:lens[b], b] = ys[i]
            fwd, kf = _lstm(x, mask, params[0])
            bwd, kb = _lstm(r, mask, params[1])
            both = np.concatenate([fwd, _turned(bwd, lens)], axis=2)
            err = (_sigmoid(both @ params[2][:-1] + params[2][-1]) - y) * mask / mask.sum()
            grads = [None, None, np.append(np.einsum("tb,tbh->h", err, both), err.sum())]
            dboth = err[:, :, None] * params[2][:-1]
            grads[0] = _lstm_back(x, kf, dboth[:, :, :HIDDEN], params[0])
            grads[1] = _lstm_back(r, kb, _turned(dboth[:, :, HIDDEN:], lens), params[1])
            step += 1
            for k, g in enumerate(grads):
                g = np.clip(g, -1, 1)
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                params[k] -= RATE * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
    return Model([p.astype(np.float32) for p in params[:2]], params[2].astype(np.float32))


def train(pages: DataFrame) -> Model:
    """Fit on the bounded sample of pages that mark their article."""
    mark = "(?i)<(article|main)[ >]"
    marked = pages.where(F.col("html").rlike(mark))
    every = pages.select("page_id", F.lit("all").alias("__all"))
    around = F.greatest(F.lit(1), F.regexp_instr("html", F.lit(mark)) - SAMPLE_CHARS // 4)
    rows = bounded_sample(marked, every, "__all", SAMPLE, SAMPLE_CHARS, text="html", id_col="page_id", piece_from=around)
    return fit([h for h, _ in rows])


def _batches(lens: list[int]) -> Iterator[list[int]]:
    """Pages of like length, about TOGETHER blocks at once."""
    held: list[int] = []
    for i in np.argsort(lens, kind="stable").tolist():
        if lens[i] == 0:
            continue
        if held and lens[i] * (len(held) + 1) > TOGETHER:
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def main_texts(pages: list[str], m: Model) -> list[str]:
    cut = [blocks(p) for p in pages]
    out = [""] * len(pages)
    for ids in _batches([len(c) for c in cut]):
        for i, p in zip(ids, probabilities([cut[i] for i in ids], m), strict=True):
            out[i] = " ".join([b.text for b, k in zip(cut[i], p >= 0.5, strict=True) if k])
    return out


def extract(pages: DataFrame, m: Model, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""

    def compute():
        def batch(b: pa.RecordBatch) -> list[pa.Array]:
            texts = main_texts([p or "" for p in b.column(b.schema.get_field_index(html)).to_pylist()], m)
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return batch

    return append_columns(pages, [StructField("text", StringType()), StructField("n_chars", LongType())], compute)
