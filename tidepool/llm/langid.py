"""Language identification by a linear-chain conditional random field.

Words are runs of ASCII letters and non-ASCII bytes.  Emissions sum learned
weights of hashed features: prefixes and suffixes of 1 to 3 bytes, every byte
trigram of the word with its borders, and the word itself where it is in the
learned lexicon.  Transitions between the languages of neighbouring words are
learned with them (maximum likelihood by forward-backward) on a bounded sample,
part of it spliced from two languages so that switches are seen.  Forward-
backward then gives each word's language marginals.  A text's chain is one from
its first word to its last: it is worked on in runs of ``RUN`` words side by
side, each run's product of transitions and emissions says how messages pass
through it, and the messages that enter a run from before and from behind are
carried along those products.  A document's language has the largest sum of
marginals; the score is its share.

Training reads at most ``PER_LANG`` documents of every language, of at most
``SAMPLE_CHARS`` code points, or the beginnings of longer ones where a language
has too few of them.  Prediction reads every whole text.

Defined results: null text or text without a letter gives ``und`` with score 0;
ties go to the language first in alphabetical order; without any labelled row
every text is ``und``; repeated rows get equal results; other columns are
carried along (``lang_pred`` and ``score`` are replaced); an empty table stays
empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from tidepool.llm.sampling import bounded_sample
from tidepool.llm.textvec import LETTERS, PIECE, Words, append_columns, mix, pieces, text_bytes, text_pieces

PER_LANG = 250
SAMPLE_CHARS = 4_000
RUN = 64
SLOTS = 1 << 16
#: A word is in the lexicon if the sample holds it this often.
LEXICON_MIN = 4
STEPS = 25
#: Texts of a training block: what the driver holds beyond the sample's features grows with it.
FIT_TEXTS = 64
#: Largest size of a transition weight.
MOST = 5.0
UND = "und"

_U = np.uint64


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # SLOTS + 1 + lexicon rows x languages
    lexicon: np.ndarray  # sorted word hashes
    transitions: np.ndarray
    start: np.ndarray


def _affixes(w: Words) -> list[np.ndarray]:
    """Slots of the six affix features, SLOTS where the word is shorter."""
    out = []
    for n in (1, 2, 3):
        has = w.end - w.start >= n
        for tag, s, e in ((n, w.start, np.minimum(w.start + n, w.end)), (n + 3, np.maximum(w.end - n, w.start), w.end)):
            slot = (w.span_hash(s, e) * _U(2 * tag + 1) >> _U(48)).astype(np.int64)
            out.append(np.where(has, slot, SLOTS))
    return out


def _trigrams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams around each byte of each word, and each word's first index."""
    b = np.concatenate(([0], w.buf, [0])).astype(np.uint32)
    inside = w.buf != 0
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    slot = (code[inside] * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64)
    lens = w.end - w.start
    return slot, np.cumsum(lens) - lens


def _lexicon_slots(lexicon: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.full(len(hashes), SLOTS)
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[at] == hashes, SLOTS + 1 + at, SLOTS)


def emissions(w: Words, m: Model) -> np.ndarray:
    """Words x languages."""
    if not len(w.start):
        return np.zeros((0, len(m.langs)), np.float32)
    tri, first = _trigrams(w)
    out = np.add.reduceat(m.weights[tri], first, axis=0)
    for slot in [*_affixes(w), _lexicon_slots(m.lexicon, w.hashes())]:
        out += m.weights[slot]
    return out


@dataclass
class Runs:
    """Texts cut into runs, longest first: the run and place of each word, and of
    each run its length, its number in its text, and the runs before and after it (-1: none)."""

    run: np.ndarray
    place: np.ndarray
    lens: np.ndarray
    level: np.ndarray
    before: np.ndarray
    after: np.ndarray


def _runs(doc: np.ndarray, counts: np.ndarray) -> Runs:
    first = np.cumsum(counts) - counts
    i = np.arange(len(doc)) - first[doc]
    per_doc = -(-counts // RUN)
    first_run = np.cumsum(per_doc) - per_doc
    run = first_run[doc] + i // RUN
    n = int(per_doc.sum())
    lens = np.bincount(run, minlength=n)
    order = np.argsort(-lens, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(n)
    level = np.arange(n) - np.repeat(first_run, per_doc)
    before = np.where(level > 0, rank[np.maximum(np.arange(n) - 1, 0)], -1)
    after = np.where(np.append(level[1:], 0) > 0, rank[np.minimum(np.arange(n) + 1, max(n - 1, 0))], -1)
    return Runs(rank[run], i % RUN, lens[order], level[order], before[order], after[order])


def _carried(e: np.ndarray, active: np.ndarray, t: np.ndarray, start: np.ndarray, r: Runs) -> tuple[np.ndarray, np.ndarray]:
    """The messages that enter each run, each scaled to a sum of 1: forward
    from the word before it, backward to its last word.  Both follow from the
    product of each run's transitions and emissions."""
    runs, k = e.shape[1:]
    f, beta = np.ones((runs, k)), np.ones((runs, k))
    depth = int(r.level.max(initial=0))
    if not depth:
        return f, beta
    through = np.broadcast_to(np.eye(k), (runs, k, k)).copy()
    for j in range(len(e)):
        c = active[j]
        step = (through[:c].reshape(-1, k) @ t).reshape(c, k, k)
        if j == 0:
            step = np.where((r.level == 0)[:, None, None], np.diag(start), step)
        through[:c] = step * e[j, :c, None, :]
    through /= through.max(axis=(1, 2), keepdims=True)
    by_level = np.argsort(r.level, kind="stable")
    bounds = np.searchsorted(r.level[by_level], np.arange(depth + 2))
    for n in range(1, depth + 1):
        at = by_level[bounds[n]:bounds[n + 1]]
        f[at] = np.matmul(f[r.before[at], None, :], through[r.before[at]])[:, 0]
        f[at] /= f[at].sum(axis=1, keepdims=True)
    for n in range(depth - 1, -1, -1):
        at = by_level[bounds[n]:bounds[n + 1]]
        at = at[r.after[at] >= 0]
        beta[at] = np.matmul(through[r.after[at]], beta[r.after[at], :, None])[:, :, 0]
        beta[at] /= beta[at].sum(axis=1, keepdims=True)
    return f, beta


def forward_backward(em: np.ndarray, r: Runs, transitions: np.ndarray, start: np.ndarray,
                     learn: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals per word and, to learn from, the expected transition and start
    counts.  A run's best path keeps a factor of at least exp(-MOST) per word
    (emissions are scaled to a largest factor of 1), so RUN words stay far from
    the smallest double; what passes from run to run is scaled."""
    n, k = em.shape
    if not n:
        return em, np.zeros((k, k)), np.zeros(k)
    run, place, lens = r.run, r.place, r.lens
    steps = int(lens[0])
    e = np.ones((steps, len(lens), k))
    e[place, run] = np.exp(em - em.max(axis=1, keepdims=True))
    t, begin = np.exp(transitions), np.exp(start)
    active = np.searchsorted(-lens, -np.arange(steps), side="left")  # runs longer than j
    f, beta = _carried(e, active, t, begin, r)
    a, b = np.ones_like(e), np.ones_like(e)
    a[0] = np.where((r.level == 0)[:, None], begin, f @ t) * e[0]
    for j in range(1, steps):
        c = active[j]
        np.matmul(a[j - 1, :c], t, out=a[j, :c])
        a[j, :c] *= e[j, :c]
    # from here on e[j] is the emission times the backward factor of word j
    last = lens - 1, np.arange(len(lens))
    b[last] = beta
    e[last] *= beta
    for j in range(steps - 1, 0, -1):
        c = active[j]
        np.matmul(e[j, :c], t.T, out=b[j - 1, :c])
        e[j - 1, :c] *= b[j - 1, :c]
    pairs, begun = np.zeros((k, k)), np.zeros(k)
    if learn:
        first = a[0] * b[0]
        z = first.sum(axis=1, keepdims=True)
        begun = (first / z)[r.level == 0].sum(axis=0)
        for j in range(1, steps):
            c = active[j]
            pairs += t * (a[j - 1, :c].T @ (e[j, :c] / z[:c]))
        inner = r.level > 0
        pairs += t * (f[inner].T @ (e[0, inner] / z[inner]))
    a *= b
    g = a[place, run]
    g /= g.sum(axis=1, keepdims=True)
    return g, pairs, begun


def _spliced(rows: list[tuple[str, str]], langs: list[str]) -> tuple[list[bytes], list[np.ndarray]]:
    """Training texts with a label per word: each document once, and each
    beginning of a document joined to the end of one of another language."""
    texts, labels = [], []
    split = [(" ".join(t.split()).encode(), langs.index(c)) for t, c in rows]
    by = {c: [t for t, x in split if x == c] for c in range(len(langs))}
    for n, (t, c) in enumerate(split):
        texts.append(t)
        labels.append([(len(t), c)])
        others = [x for x in by if x != c and by[x]]
        if others:
            o = others[n % len(others)]
            other = by[o][n % len(by[o])].split(b" ")
            head = t.split(b" ")[: 10 + n % 20]
            joined = b" ".join(head)
            texts.append(joined + b" " + b" ".join(other[-(10 + n % 15):]))
            labels.append([(len(joined), c), (1 << 60, o)])
    return texts, labels


@dataclass
class _Block:
    """Training texts worked on together: their features and labels in narrow arrays."""

    flat: np.ndarray  # trigram slots, then the slots of the other features
    first: np.ndarray
    slots: list[np.ndarray]
    owner: np.ndarray  # word of each entry of flat
    y: np.ndarray
    runs: Runs


def _blocks(texts: list[bytes], labels: list[list[tuple[int, int]]], lexicon: np.ndarray) -> Iterator[_Block]:
    for at in range(0, len(texts), FIT_TEXTS):
        w = Words(texts[at:at + FIT_TEXTS], LETTERS)
        if not len(w.start):
            continue
        y = np.zeros(len(w.start), np.int32)
        for d, spans in enumerate(labels[at:at + FIT_TEXTS]):
            mine = slice(*np.searchsorted(w.doc, [d, d + 1]))
            bounds = np.array([x for x, _ in spans])
            y[mine] = np.array([c for _, c in spans])[np.searchsorted(bounds, w.start[mine] - w.text_start[d], side="right")]
        tri, first = _trigrams(w)
        slots = [x.astype(np.int32) for x in (*_affixes(w), _lexicon_slots(lexicon, w.hashes()))]
        words = np.arange(len(w.start), dtype=np.int32)
        yield _Block(np.concatenate([tri.astype(np.int32), *slots]), first, slots,
                     np.concatenate([np.repeat(words, w.end - w.start), *[words] * len(slots)]), y, _runs(w.doc, w.counts()))


def fit(rows: list[tuple[str, str]]) -> Model:
    """Weights, lexicon and transitions by full-batch adaptive gradient steps,
    each summed over blocks of FIT_TEXTS texts."""
    langs = sorted({c for _, c in rows})
    k = len(langs)
    texts, labels = _spliced(rows, langs)
    hashes = [Words(texts[at:at + FIT_TEXTS], LETTERS).hashes() for at in range(0, len(texts), FIT_TEXTS)]
    uniq, n = np.unique(np.concatenate([np.zeros(0, _U), *hashes]), return_counts=True)
    m = Model(langs, np.zeros((0, k)), uniq[n >= LEXICON_MIN], np.zeros((k, k)), np.zeros(k))
    m.weights = np.zeros((SLOTS + 1 + len(m.lexicon), k), np.float32)
    blocks = list(_blocks(texts, labels, m.lexicon))
    if not blocks:
        return m
    starts, follows, total = np.zeros(k), np.zeros((k, k)), sum(len(x.y) for x in blocks)
    for x in blocks:
        begins = (x.runs.place == 0) & (x.runs.level[x.runs.run] == 0)
        starts += np.bincount(x.y[begins], minlength=k)
        nxt = np.flatnonzero(~begins[1:])
        np.add.at(follows, (x.y[nxt], x.y[nxt + 1]), 1)
    sq, sq_t, sq_s = np.full(m.weights.shape, 1e-3), np.full((k, k), 1e-3), np.full(k, 1e-3)
    eye = np.eye(k)
    for _ in range(STEPS):
        step, pairs, begun = np.zeros(m.weights.shape), np.zeros((k, k)), np.zeros(k)
        for x in blocks:
            em = np.add.reduceat(m.weights[x.flat[:len(x.flat) - len(x.slots) * len(x.y)]], x.first, axis=0)
            for s in x.slots:
                em += m.weights[s]
            g, p, q = forward_backward(em, x.runs, m.transitions, m.start, learn=True)
            pairs, begun = pairs + p, begun + q
            err = (eye[x.y] - g) / total * 1e3
            for c in range(k):
                step[:, c] += np.bincount(x.flat, weights=err[x.owner, c], minlength=len(m.weights))
        step -= 1e-3 * m.weights
        step[SLOTS] = 0
        sq += step * step
        m.weights += (0.25 * step / np.sqrt(sq)).astype(np.float32)
        for value, cell, grad in ((m.transitions, sq_t, follows - pairs), (m.start, sq_s, starts - begun)):
            grad = grad / total * 1e3 - 1e-3 * value
            cell += grad * grad
            value += 0.2 * grad / np.sqrt(cell)
            np.clip(value, -MOST, MOST, out=value)
    return m


def label_words(texts: list[bytes], m: Model) -> tuple[Words, np.ndarray]:
    """Words and their language marginals."""
    w = Words(texts, LETTERS)
    em = emissions(w, m)
    return w, forward_backward(em, _runs(w.doc, w.counts()), m.transitions, m.start)[0]


def predict(texts: list[bytes], m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language with the largest sum of marginals, and its share."""
    w, g = label_words(texts, m)
    sums = np.stack([np.bincount(w.doc, weights=g[:, c], minlength=len(texts)) for c in range(len(m.langs))], axis=1)
    best = sums.argmax(axis=1)
    return best, sums[np.arange(len(texts)), best] / np.maximum(w.counts(), 1)


def train(docs: DataFrame, label: str = "lang") -> Model:
    """Fit on the bounded sample of labelled rows outside the held-out fold."""
    return fit(bounded_sample(docs, docs, label, PER_LANG, SAMPLE_CHARS, piece_from=F.lit(1)))


def identify(docs: DataFrame, m: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""

    def compute():
        def batch(b: pa.RecordBatch) -> list[pa.Array]:
            column = b.column(b.schema.get_field_index(text))
            letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names, scores = np.full(b.num_rows, UND, dtype=object), np.zeros(b.num_rows)
            # a run's product has a number for each pair of languages
            size = max(1 << 14, PIECE * 64 // (64 + len(m.langs) ** 2))
            if m.langs:
                for first, texts in text_pieces(column, size):
                    best, share = predict(texts, m)
                    here = slice(first, first + len(texts))
                    names[here] = np.array(m.langs, dtype=object)[best]
                    scores[here] = share
            names[~letters], scores[~letters] = UND, 0.0
            return [pa.array(names, pa.string()), pa.array(np.clip(scores, 0.0, 1.0))]

        return batch

    return append_columns(docs, [StructField("lang_pred", StringType()), StructField("score", DoubleType())], compute)
