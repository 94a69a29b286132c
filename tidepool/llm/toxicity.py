"""Toxicity by compression distance.

Two zstandard dictionaries are made.  The ordinary one is trained on windows of
ordinary text.  The toxic one holds, after the same trained tables and content,
the passages that set toxic text apart: for byte n-grams that toxic documents
have significantly more often, the commonest toxic words around them (training
on raw toxic windows would only learn the language again).  Each window of
``WINDOW`` words is compressed with both; the bytes that the toxic dictionary
saves are the window's gain.  The gains of all windows of a text are summarised
(mean and largest gain, windows over each of ``LEVELS``), and a logistic
calibration on training documents turns the summary into a score.

Training reads at most ``PER_LABEL`` documents of each label, of at most
``SAMPLE_CHARS`` code points, from the training fold; 3 of 4 of them make the
dictionaries, and all of them the calibration.  Scores use the text alone.

Defined results: null and empty texts have no window and get the score of a
text without gains; a text of any length is scored whole; without labelled rows
of both kinds every score is 0; repeated rows get equal results; other columns
are carried along (``score`` and ``predicted`` are replaced); an empty table
stays empty.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from tidepool.llm.sampling import bounded_sample
from tidepool.llm.textvec import append_columns, text_bytes

WINDOW = 4
PER_LABEL = 1_500
SAMPLE_CHARS = 20_000
ORDINARY_BYTES, TOXIC_BYTES = 8_192, 2_048
#: Lengths of the n-grams; least significance and least frequency ratio of a toxic one, most of them, and words kept for each.
NGRAMS, LEAST_Z, LEAST_RATIO, MOST_PIECES, WORDS_PER_PIECE = (5, 6, 7, 8), 5.0, 3.0, 128, 1
#: Gains (bytes) whose shares of windows are features.
LEVELS = (2, 3, 4, 5, 6)
ZSTD_LEVEL = 5
#: The last bytes of a dictionary are in no match table, so filler follows the content.
UNINDEXED = 16


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: np.ndarray | None = None
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    _pair: tuple = field(default=(), repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_pair": ()}

    def compressors(self) -> tuple:
        if not self._pair:
            made = []
            # appended, so both keep the trained entropy tables, without which short windows would be
            # stored as they are; filler of the same length keeps all offsets alike
            for end in (b" " * len(self.toxic), self.toxic):
                d = zstandard.ZstdCompressionDict(self.ordinary + end + b" " * UNINDEXED)
                d.precompute_compress(level=ZSTD_LEVEL)
                made.append(zstandard.ZstdCompressor(level=ZSTD_LEVEL, dict_data=d, write_content_size=False,
                                                     write_checksum=False, write_dict_id=False))
            self._pair = tuple(made)
        return self._pair


def windows(text: bytes) -> list[bytes]:
    ws = text.lower().split()
    return [b" %b " % b" ".join(ws[i:i + WINDOW]) for i in range(0, len(ws), WINDOW)]


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _pieces(text: bytes) -> set[bytes]:
    out = set()
    for w in set(text.lower().split()):
        w = b" %b " % w
        for n in NGRAMS:
            out.update([w[i:i + n] for i in range(len(w) - n + 1)])
    return out


def toxic_pieces(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """N-grams that toxic documents hold significantly more often, best first."""
    a, b = Counter(), Counter()
    for t in toxic:
        a.update(_pieces(t))
    wanted = {g for g, c in a.items() if c >= 3}
    for t in ordinary:
        b.update(_pieces(t) & wanted)
    n1, n0 = max(len(toxic), 1), max(len(ordinary), 1)

    def z(g: bytes) -> float:
        p1, p0 = a[g] / n1, b[g] / n0
        p = (a[g] + b[g] + 1) / (n1 + n0 + 2)
        return (p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))

    chosen, parts = [], set()
    often = [g for g in wanted if a[g] / n1 >= LEAST_RATIO * b[g] / n0]
    for s, _, g in sorted(((z(g), len(g), g) for g in often), reverse=True):
        if s < LEAST_Z or len(chosen) == MOST_PIECES:
            break
        own = {g[i:i + 4] for i in range(len(g) - 3)}
        if not own & parts:  # else it overlaps a better one
            chosen.append(g)
            parts |= own
    return chosen


def _passages(pieces: list[bytes], toxic: list[bytes]) -> bytes:
    """Dictionary content: the commonest words of toxic text around each piece, the best piece last
    (zstandard reaches the end of a dictionary at the least cost)."""
    words = Counter(w for t in toxic for w in t.lower().split())
    out = []
    for p in pieces:
        around = [w for w, _ in words.most_common() if p in b" %b " % w][:WORDS_PER_PIECE]
        out.append(b"".join(b" %b " % w for w in reversed(around)))
    return b"".join(reversed(out))[-TOXIC_BYTES:]


def gains(text: bytes, m: Model) -> np.ndarray:
    """Bytes that the toxic dictionary saves on each window."""
    plain, toxic = m.compressors()
    return np.array([len(plain.compress(w)) - len(toxic.compress(w)) for w in windows(text)], dtype=np.int64)


def summary(g: np.ndarray) -> np.ndarray:
    if not len(g):
        return np.zeros(len(LEVELS) * 2 + 3)
    over = [int((g >= x).sum()) for x in LEVELS]
    top = np.sort(g)[-4:]
    return np.array([max(g.mean(), -1.0), float(np.clip(top[-1], 0, 12)), float(np.clip(top.mean(), 0, 12)),
                     *[np.log1p(o) for o in over], *[np.sqrt(o / len(g)) for o in over]])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - 0.5 * w)
    return w


def fit(rows: list[tuple[str, int]]) -> Model:
    texts = [(t.encode(), int(y)) for t, y in rows]
    toxic, ordinary = [t for t, y in texts if y], [t for t, y in texts if not y]
    if not toxic or not ordinary:
        return Model()
    # the calibration sees documents that the dictionaries have not
    fit_toxic, fit_ordinary = toxic[:-(len(toxic) // 4) or None], ordinary[:-(len(ordinary) // 4) or None]
    pieces = toxic_pieces(fit_toxic, fit_ordinary)
    m = Model(_trained([w for t in fit_ordinary[:400] for w in windows(t)], ORDINARY_BYTES))
    m.toxic = _passages(pieces, fit_toxic)
    x = np.array([summary(gains(t, m)) for t in toxic + ordinary])
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    m.centre, m.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    m.weights = _logistic((x - m.centre) / m.scale, y)
    return m


def score(text: bytes, m: Model) -> float:
    if m.weights is None:
        return 0.0
    x = (summary(gains(text, m)) - m.centre) / m.scale
    return float(1 / (1 + np.exp(-np.clip(x @ m.weights[:-1] + m.weights[-1], -30, 30))))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample of labelled documents outside the held-out fold."""
    marked = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    return fit(bounded_sample(docs, marked, "__toxic", PER_LABEL, SAMPLE_CHARS, spare=2))


def rate(docs: DataFrame, m: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""

    def compute():
        def batch(b: pa.RecordBatch) -> list[pa.Array]:
            s = np.array([score(t or b"", m) for t in text_bytes(b.column(b.schema.get_field_index(text)))])
            return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]

        return batch

    return append_columns(docs, [StructField("score", DoubleType()), StructField("predicted", IntegerType())], compute)
