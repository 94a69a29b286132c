"""Personal data by a skip-chain conditional random field.

Base spans come from fixed patterns (e-mail address, IP address, payment card,
international telephone number).  A skip-chain CRF then labels every token that
holds a digit or an ``@`` (all other tokens are outside any entity, which cuts
the chain into short pieces): unary potentials on the token's shape, chain
potentials between neighbouring tokens, and skip potentials between tokens of
one document, however distant, that are the same or similar (equal letters and
digits, equal last digits, or an equal mailbox name).  Base spans are clamped
as evidence; loopy belief propagation over all graphs of a batch at once makes
labels agree across the document, so a number that is written once with its
country code is also found where the code is missing.  Runs of tokens with one
confident label that touch no base span are added; base spans always stay.

Of similar tokens each is linked to the next, and each to the nearest one under
a base span (the last before it, else the first after it), so a number repeated
ten thousand times costs at most twice as many links, not their square, and a
mention gets the evidence however many others lie between.  Messages are passed
on until they stop changing.

Weights are learned by pseudo-likelihood on a bounded sample of at most
``SAMPLE`` documents (of at most ``SAMPLE_CHARS`` code points), labelled by the
base patterns and extended with rewritten mentions: of entities of the same
document (to be labelled alike) and of made-up numbers of the same shape (to be
left alone).

Defined results: null and empty texts have no span; equal rows get equal
results; offsets are code points, ends exclusive; without any sample only base
spans are given; other columns are carried along (those of the result's names
are replaced); an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tidepool.llm.sampling import bounded_sample
from tidepool.llm.textvec import append_columns

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0 is outside
SAMPLE, SAMPLE_CHARS = 1_500, 6_000
#: Least belief of an added span, and texts of a batch that share a graph (code points).
SURE, TOGETHER = 0.5, 1 << 22
#: Digits from which a token is a number of its own.
WHOLE = 7
#: A message that changes less is settled.  Messages that circle for ever end after the nodes of their text (no way
#: through it is longer) and so many rounds.
SETTLED, CIRCLES = 1e-4, 1000
#: Evidence of a base span, in log units.
EVIDENCE = 12.0

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive, and only from the start of a run of digits: the same matches in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_NOT_ALNUM = re.compile(r"[\W_]+")
#: Tokens with a digit or an @, from their start, in linear time.
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
#: Tokens of digits and the signs inside numbers, a space apart; and each of them.
_SPACED = re.compile(r"(?<![^\s(+])[+(]?[0-9][0-9().-]*+(?: [0-9(][0-9().-]*+)+")
_DIGITS = re.compile(r"[0-9(][0-9().-]*[0-9)]|[0-9]")
_EDGES = "\"'.,;:!?*#$%&|<>[]{}=`~_"

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind, then start."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m.group().split("."))):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


@dataclass
class Model:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray  # labels x labels


_DIGIT_STEPS = (1, 4, 7, 9, 13, 20)
#: Features: bias, digits (7), dots (5), and 13 marks of the shape.
N_FEATURES = 1 + 7 + 5 + 13


def _features(core: str, digits: str, before: str) -> list[int]:
    parts = core.split(".")
    dots = min(len(parts) - 1, 4)
    marks = (
        "@" in core,
        "@" in core and "." in core.split("@")[-1],
        len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts),
        core.startswith("+"),
        "(" in core,
        "-" in core,
        any(c.isalpha() for c in core[:64]),
        13 <= len(digits) <= 19 and luhn(digits),
        len(digits) == len(core),
        before.endswith('"'),
        "=" in before,
        before.rstrip()[-1:].isdigit() or before.rstrip()[-1:] == ")",
        before.rstrip()[-1:] in ("+", "@"),
    )
    return [0, 1 + sum(len(digits) >= s for s in _DIGIT_STEPS), 8 + dots, *[13 + i for i, on in enumerate(marks) if on]]


def _keys(core: str, digits: str) -> list[str]:
    """What similar tokens have in common."""
    keys = []
    if "@" in core:
        keys.append("m" + _NOT_ALNUM.sub("", core.split("@")[0].lower()))
    if len(digits) >= 5:
        keys.append("d" + digits[-10:])
        keys.append("e" + digits[-7:])
    return keys


def _spaced_numbers(text: str, spans: list[Span]) -> tuple[dict[int, str], dict[int, int]]:
    """Numbers that are written with spaces.  Under base spans: the end of each
    of their tokens -> all digits of the span for the last one, none for the
    others.  Elsewhere tokens of less than seven digits a space apart are one
    number, with one of more before them: the start of the first -> the end of the last."""
    digits_of: dict[int, str] = {}
    one: dict[int, int] = {}
    for m in _SPACED.finditer(text):
        covered = [(s, e) for k, s, e in spans if k >= 2 and s < m.end() and m.start() < e]
        groups: list[tuple[tuple | None, list[tuple[int, int]]]] = []
        for x in _DIGITS.finditer(m.group()):
            s, e = m.start() + x.start(), m.start() + x.end()
            own = next((c for c in covered if c[0] <= s < c[1]), None)
            alone = own is None and len(_NOT_DIGIT.sub("", text[s:e])) >= WHOLE  # long enough for a number of its own
            if not groups or groups[-1][0] != own or alone:
                groups.append((own, []))
            groups[-1][1].append((s, e))
        for own, pieces in groups:
            if len(pieces) > 1 and own is not None:
                digits_of.update((e, "") for _, e in pieces[:-1])
                digits_of[pieces[-1][1]] = _NOT_DIGIT.sub("", text[pieces[0][0]:pieces[-1][1]])
            elif len(pieces) > 1:
                one[pieces[0][0]] = pieces[-1][1]
    return digits_of, one


class Graph:
    """Tokens of several texts, their features, and their links."""

    def __init__(self) -> None:
        self.text: list[int] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.label: list[int] = []  # of the base span that covers the token's core, else -1
        self.rows: list[int] = []
        self.cols: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, index: int, text: str, spans: list[Span]) -> None:
        last: dict[str, int] = {}
        sure: dict[str, int] = {}  # last occurrence under a base span
        waiting: dict[str, list[int]] = {}  # occurrences before the first of these
        first = len(self.text)
        digits_of, one = _spaced_numbers(text, spans)
        upto = 0  # end of a number of several tokens
        by_start = sorted(spans, key=lambda s: s[1])
        k, reach, before_end = 0, [], -1
        for m in _TOKEN.finditer(text):
            raw = m.group()
            core = raw.lstrip(_EDGES)
            start = m.start() + len(raw) - len(core)
            core = core.rstrip(_EDGES)
            if not core or start < upto:
                before_end = max(before_end, m.end()) if core else before_end
                continue
            end = upto = max(start + len(core), one.get(start, 0))
            core = text[start:end]
            node = len(self.text)
            digits = _NOT_DIGIT.sub("", core)
            while k < len(by_start) and by_start[k][1] < end:
                reach.append(by_start[k])
                k += 1
            reach = [s for s in reach if s[2] > start]
            self.text.append(index)
            self.start.append(start)
            self.end.append(end)
            self.label.append(reach[0][0] if reach else -1)
            f = _features(core, digits, text[max(m.start() - 4, 0):start])
            self.rows += [node] * len(f)
            self.cols += f
            if node > first and text[before_end:m.start()].isspace():
                self.chain.append((node - 1, node))
            before_end = m.end()
            linked = set()
            # the last token of a base span stands for the whole
            for key in _keys(core, digits_of.get(end, digits)):
                for other in (last.get(key), None if reach else sure.get(key)):
                    if other is not None and other not in linked:
                        self.skip.append((other, node))
                        linked.add(other)
                if reach:
                    for other in waiting.pop(key, ()):
                        if other not in linked:
                            self.skip.append((other, node))
                            linked.add(other)
                    sure[key] = node
                elif key not in sure:
                    waiting.setdefault(key, []).append(node)
                last[key] = node

    def arrays(self, m: Model | None = None) -> tuple:
        x = np.zeros((len(self.text), N_FEATURES))
        x[self.rows, self.cols] = 1
        return x, np.array(self.chain, np.int64).reshape(-1, 2), np.array(self.skip, np.int64).reshape(-1, 2)


def beliefs(g: Graph, m: Model) -> np.ndarray:
    """Label marginals by loopy belief propagation, base spans clamped."""
    x, chain, skip = g.arrays()
    n = len(x)
    log_u = x @ m.unary
    label = np.array(g.label, np.int64)
    known = np.flatnonzero(label >= 0)
    log_u[known] = EVIDENCE * np.eye(LABELS)[label[known] + 1]
    src = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    dst = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    c, s = len(chain), len(skip)
    back = np.concatenate([np.arange(c) + c, np.arange(c), 2 * c + s + np.arange(s), 2 * c + np.arange(s)])
    table = np.exp(np.stack([m.chain, m.chain.T, m.skip, m.skip.T]))[np.repeat([0, 1, 2, 3], [c, c, s, s])]
    msg = np.zeros((len(src), LABELS))
    total = log_u.copy()  # with all messages
    # edges by source, to find those that a changed node sends on
    order = np.argsort(src, kind="stable")
    begin = np.searchsorted(src[order], np.arange(n + 1))
    text = np.array(g.text, np.int64)
    limit = (np.bincount(text) + CIRCLES)[text][src] if n else np.empty(0, np.int64)
    # clamped nodes take no messages: thousands of mentions do not outvote the base span that they follow
    active, done = np.flatnonzero(label[dst] < 0), 0
    while len(active):
        cavity = total[src[active]] - msg[back[active]]
        out = np.einsum("ex,exy->ey", np.exp(cavity - cavity.max(axis=1, keepdims=True)), table[active])
        step = 0.5 * (np.log(out / out.sum(axis=1, keepdims=True) + 1e-12) - msg[active])
        msg[active] += step
        np.add.at(total, dst[active], step)
        done += 1
        moved = active[np.abs(step).max(axis=1) > SETTLED]
        nodes = np.unique(dst[moved])
        many = begin[nodes + 1] - begin[nodes]
        onward = order[np.repeat(begin[nodes] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        active = np.union1d(moved, onward)
        active = active[(limit[active] > done) & (label[dst[active]] < 0)]
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(texts: list[str], base: list[list[Span]], m: Model | None) -> list[list[Span]]:
    """Spans that the field adds to the base spans of each text."""
    out: list[list[Span]] = [[] for _ in texts]
    if m is None:
        return out
    g = Graph()
    for i, (t, spans) in enumerate(zip(texts, base, strict=True)):
        g.add(i, t, spans)
    if not g.text:
        return out
    p = beliefs(g, m)
    best = p.argmax(axis=1)
    sure = (best > 0) & (p.max(axis=1) >= SURE) & (np.array(g.label) < 0)
    # two whole numbers side by side are two mentions
    long = [len(_NOT_DIGIT.sub("", texts[i][s:e])) >= WHOLE for i, s, e in zip(g.text, g.start, g.end)]
    chained = {b for a, b in g.chain if best[a] == best[b] and sure[a] and sure[b] and not (long[a] and long[b])}
    run: list[int] = []
    for node in [*np.flatnonzero(sure).tolist(), -1]:
        if run and node not in chained:
            out[g.text[run[0]]].append((int(best[run[0]]) - 1, g.start[run[0]], g.end[run[-1]]))
            run = []
        run.append(node)
    return out


def _rewritten(kind: int, s: str, other: str, spaced: bool = False) -> str:
    """Another way to write an entity, as people do; numbers also in groups a space apart."""
    if kind == 0:
        return s.rsplit(".", 1)[0] if "." in s.split("@")[-1] else s
    if kind == 1:
        return s.replace(".", "-")
    if kind == 2:
        digits = _NOT_DIGIT.sub("", s)
        return (" " if spaced else ".").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    bare = re.sub(r"^\+[0-9]+[ .-]?", "", s) or other
    return _NOT_DIGIT.sub(" ", bare).strip() or other if spaced else bare


def _training_graph(texts: list[str]) -> tuple[Graph, np.ndarray]:
    g, labels = Graph(), []
    rng = np.random.default_rng(7)
    for i, t in enumerate(texts):
        spans = base_spans(t)
        truth = {(s, e): k for k, s, e in spans}
        if spans:
            # a rewritten mention of each of a few entities, and the same shape with other digits
            for n, (k, s, e) in enumerate(spans[:4]):
                mention = _rewritten(k, t[s:e], t[s:e], (i + n) % 2 == 1)
                strange = "".join(str(rng.integers(10)) if c.isdigit() else "q" if c.isalpha() else c for c in mention)
                for text, kind in ((mention, k), (strange, None)):
                    t += " and "
                    if kind is not None:
                        truth[(len(t), len(t) + len(text))] = kind
                    t += text
        first = len(g.text)
        g.add(i, t, [])
        for n in range(first, len(g.text)):
            hit = [k for (s, e), k in truth.items() if s < g.end[n] and g.start[n] < e]
            labels.append(hit[0] + 1 if hit else 0)
    return g, np.array(labels, np.int64)


def fit(texts: list[str]) -> Model | None:
    """Pseudo-likelihood of each token given its features and its neighbours' labels."""
    g, y = _training_graph(texts)
    if not len(y) or not y.any():
        return None
    x, chain, skip = g.arrays()
    onehot = np.eye(LABELS)[y]

    def gathered(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(dst, weights=onehot[src, c], minlength=len(y)) for c in range(LABELS)], axis=1)

    left, right = gathered(chain[:, 0], chain[:, 1]), gathered(chain[:, 1], chain[:, 0])
    twin = gathered(skip[:, 0], skip[:, 1]) + gathered(skip[:, 1], skip[:, 0])
    design = np.hstack([x, left, right, twin])
    counts = np.bincount(y, minlength=LABELS)
    weight = np.sqrt(counts.max() / np.maximum(counts, 1))[y][:, None]
    w = np.zeros((design.shape[1], LABELS))
    sq = np.full(w.shape, 1e-6)
    for _ in range(300):
        z = design @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        grad = design.T @ ((onehot - p) * weight) - 1e-4 * w
        sq += grad * grad
        w += 0.5 * grad / np.sqrt(sq)
    f = N_FEATURES
    chain_w = (w[f:f + LABELS] + w[f + LABELS:f + 2 * LABELS].T) / 2
    twin_w = w[f + 2 * LABELS:]
    return Model(w[:f], chain_w, (twin_w + twin_w.T) / 2)


def train(docs: DataFrame) -> Model | None:
    """Fit on the bounded sample of texts that hold a digit or an @."""
    some = docs.where(F.col("text").rlike("[0-9@]"))
    every = docs.select("doc_id", F.lit("all").alias("__all"))
    return fit([t for t, _ in bounded_sample(some, every, "__all", SAMPLE, SAMPLE_CHARS, spare=20)])


def joined(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans)])


def _stretches(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, t in enumerate(texts):
        if i > first and total + len(t) > TOGETHER:
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)


def find(docs: DataFrame, m: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans and n_added."""

    def compute():
        def batch(b: pa.RecordBatch) -> list[pa.Array]:
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            base = [base_spans(t) for t in texts]
            more: list[list[Span]] = []
            for i, j in _stretches(texts):
                more += added_spans(texts[i:j], base[i:j], m)
            counts = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in range(len(KINDS))]
            digests = [hashlib.sha256(joined(x).encode()).hexdigest() for x in base]
            spans = [joined(x + y) for x, y in zip(base, more, strict=True)]
            return [*counts, pa.array(digests, pa.string()), pa.array(spans, pa.string()),
                    pa.array([len(y) for y in more], pa.int64())]

        return batch

    fields = [*[StructField(f"n_{k}", LongType()) for k in KINDS], StructField("base_sha256", StringType()),
              StructField("spans", StringType()), StructField("n_added", LongType())]
    return append_columns(docs, fields, compute)
