"""Whole-column text helpers for Arrow tasks: words, their 64-bit hashes and
word n-grams of many texts at once, in bounded pieces.

Words are runs of bytes that a 256-entry table keeps (mapping byte to byte; 0
separates).  Hashes are polynomial prefix sums modulo 2**64, so any substring
hash costs two lookups; a finalising mix spreads them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: Bytes of text that are worked on at once (a longer text is a piece of its own).
PIECE = 1 << 20

_U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.empty(max(n, 1 << 16), dtype=_U)
        have[0] = 1
        have[1:] = _U(base)
        np.multiply.accumulate(have, out=have)
        if n <= 4 * PIECE:
            _powers[base] = have
    return have[:n]


def _byte_values() -> np.ndarray:
    v = mix(np.arange(1, 257, dtype=_U))
    return v | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


BYTE_VALUES = _byte_values()


def _lower_table(keep: Callable[[int], bool]) -> np.ndarray:
    t = np.zeros(256, dtype=np.uint8)
    for b in range(256):
        if keep(b):
            t[b] = b + 32 if 65 <= b <= 90 else b
    return t


#: Words between white space (0x20, 0x09-0x0D), A-Z lower-cased.  Byte 0 inside a word is kept as 0xFF (never in UTF-8).
SPACED = _lower_table(lambda b: not (b == 32 or 9 <= b <= 13))
SPACED[0] = 0xFF
#: Runs of ASCII letters and non-ASCII bytes, A-Z lower-cased.
LETTERS = _lower_table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


class Words:
    """Words of a piece: bytes ``buf``, word bounds ``start``/``end``, the
    index ``doc`` of each word's text, and the number of texts."""

    def __init__(self, texts: list[bytes], table: np.ndarray):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.buf = table[raw]
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.text_start = np.concatenate(([0], np.cumsum(lens)))
        self.buf[self.text_start[1:] - 1] = 0
        kept = np.concatenate(([False], self.buf != 0, [False]))
        edge = np.flatnonzero(kept[1:] != kept[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.n_texts = len(texts)
        self._prefix: np.ndarray | None = None

    def prefix(self) -> np.ndarray:
        if self._prefix is None:
            terms = BYTE_VALUES[self.buf]
            terms *= power_table(BASE, len(terms))
            self._prefix = np.concatenate((np.zeros(1, _U), np.cumsum(terms, dtype=_U)))
        return self._prefix

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span (equal bytes, equal hash)."""
        p = self.prefix()
        h = (p[end] - p[start]) * power_table(BASE_INVERSE, len(p))[start]
        return mix(h + (end - start).astype(_U))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.doc, minlength=self.n_texts)


def grams(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that begin at each of the first len - k + 1 words."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    h = np.zeros(n, _U)
    for j in range(k):
        h = (h + word_hash[j:j + n]) * _U(BASE) + _U(j + 1)
    return mix(h)


def pieces(texts: list[bytes | None] | list[str], size: int = PIECE) -> Iterator[tuple[int, list]]:
    """(index of the first text, texts) with about ``size`` bytes each; null is empty."""
    first, held, total = 0, [], 0
    for i, t in enumerate(texts):
        t = b"" if t is None else t
        if held and total + len(t) > size:
            yield first, held
            first, held, total = i, [], 0
        held.append(t)
        total += len(t)
    if held:
        yield first, held


def text_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def text_pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """``pieces(text_bytes(column), size)``, but only the texts of one piece are
    held beside the column, however large its batch is."""
    lens = pc.fill_null(pc.binary_length(column), 0).to_numpy().tolist()
    first = total = 0
    for i, n in enumerate(lens):
        if i > first and total + n > size:
            yield first, [b"" if t is None else t for t in text_bytes(column.slice(first, i - first))]
            first, total = i, 0
        total += n
    if lens:
        yield first, [b"" if t is None else t for t in text_bytes(column.slice(first))]


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow.  Python workers live on from stage to stage: what
    ``run`` has freed goes back to the system when its task ends."""

    def ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
                trim(0)

    return ending


def append_columns(df: DataFrame, fields: list[StructField],
                   compute: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]]) -> DataFrame:
    """``df`` with computed columns; columns of the same names are replaced.
    ``compute()`` is called once per task and gives the batch function."""
    names = {f.name for f in fields}
    kept = [f.name for f in df.schema.fields if f.name not in names]
    schema = StructType([f for f in df.schema.fields if f.name not in names] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = compute()
        for b in batches:
            if b.num_rows:
                new = fn(b)
                yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(n)) for n in kept] + new,
                                                 names=kept + [f.name for f in fields])

    return df.mapInArrow(lean(run), schema)
