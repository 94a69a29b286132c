"""Repeated passages by sparse suffix arrays.

Only suffixes that begin at content-selected positions are kept: of every
``WINDOW`` consecutive ``GRAM``-word grams the one with the smallest hash.  So
every passage of ``LEAST`` words has one suffix that *owns* it: the one selected
among the grams that begin in its first ``WINDOW`` words.  Which one that is
depends on the words of the passage alone, and the suffix shares at least
``LEAST - WINDOW + 1`` words after it with the same suffix of any other document
that holds the passage.

1. *Select* positions and the passages that each owns; keep those whose next
   ``LEAST - WINDOW + 1`` words also follow a selected position of a different
   text (a partial aggregate per hash).
2. *Sort* the kept suffixes of all documents into one order, dealt over the
   cluster by ranges: by the hash of those next words, the words that follow
   them, and the words before in reverse, as far as owned passages reach.  The
   range key ends in text and position, so suffixes that many documents share
   are spread over tasks.
3. *Compare* neighbours.  Suffixes that are equal over all their passages lie
   side by side; where they are of different texts, all of them repeat.  What a
   suffix shares ahead with the neighbouring different suffixes is the most it
   shares with any, so owned passages that reach further are nowhere else.
4. The other owned passages of *unlike* suffixes are told apart by a hash each:
   those whose hash occurs in two texts repeat (a partial aggregate and a join).
   Equal suffixes send theirs once.  No partner is left out for being far in
   the order, in another range, or behind many rows of one text.
5. Overlapping spans of a document merge.

Words are runs without white space, A-Z lower-cased.  Suffixes carry a 64-bit
hash of the words they share and 32 bits for each other word.  Texts that are
equal as a whole are one text here, and are repeated from end to end if they
have ``LEAST`` words and different ids.

What is found: every passage of ``LEAST`` words or more that another document
holds, and nothing else (up to equal hashes of different words).

Defined results: null and empty texts and texts under ``LEAST`` words give no
row, nor do repetitions inside one document; a null id is a document of its
own by its text; rows that repeat id and text are one document; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.scratch import saved
from tidepool.llm.textvec import SPACED, Words, grams, pieces, text_bytes

LEAST, WINDOW, GRAM = 50, 28, 8
#: Words that the selected suffix of a shared passage shares at least.
SHARED = LEAST - WINDOW + 1
#: Bytes of a word's code.
CODE = 4


def _owned(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text index, word position, fewest and most words before it) of the
    selected grams: sliding minima within each text, the leftmost of equal ones.
    The passages that a position owns begin so many words before it."""
    n = len(hashes)
    if n < LEAST:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    doc = np.repeat(np.arange(len(counts)), counts)
    g = grams(hashes, GRAM)
    rank = np.empty(len(g), np.int64)
    rank[np.lexsort((np.arange(len(g)), g))] = np.arange(len(g))  # distinct, so minima are unique
    wins = n - LEAST + 1
    begin = np.flatnonzero(doc[:wins] == doc[LEAST - 1:])
    # sliding minimum by doubling
    low, width = rank.copy(), 1
    while 2 * width <= WINDOW:
        low[:len(low) - width] = np.minimum(low[:len(low) - width], low[width:])
        width *= 2
    low = np.minimum(low[:wins], low[WINDOW - width:WINDOW - width + wins])
    at = np.empty(len(g), np.int64)
    at[rank] = np.arange(len(g))
    # passages of one owner follow each other
    picked, index, many = np.unique(at[low[begin]], return_index=True, return_counts=True)
    most = picked - begin[index]
    first = np.cumsum(counts) - counts
    return doc[picked], picked - first[doc[picked]], most - many + 1, most


def _selected(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, word position) of the selected grams."""
    return _owned(hashes, counts)[:2]


def _survey(docs: DataFrame) -> DataFrame:
    """One pass: (doc_id, th, n) of each document, and (th, pos, g) of each
    selected suffix; ``pos`` also holds which passages it owns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "th", "n", "pos", "g"]
        for b in batches:
            ids, th_all = b.column(0), b.column(1).to_numpy()
            for start, texts in pieces(text_bytes(b.column(2))):
                w = Words(texts, SPACED)
                hashes, counts = w.hashes(), w.counts()
                th = th_all[start:start + len(texts)]
                none = pa.nulls(len(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([ids.slice(start, len(texts)), pa.array(th), pa.array(counts), none, none],
                                                 names=names)
                doc, pos, fewest, most = _owned(hashes, counts)
                if len(doc):
                    first = np.cumsum(counts) - counts
                    g = grams(hashes, SHARED)[first[doc] + pos].view(np.int64)
                    none = pa.nulls(len(doc), pa.int64())
                    yield pa.RecordBatch.from_arrays([none, pa.array(th[doc]), none, pa.array((pos * WINDOW + fewest) * WINDOW + most),
                                                      pa.array(g)], names=names)

    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text").where("text is not null")
            .mapInArrow(run, "doc_id bigint, th bigint, n bigint, pos bigint, g bigint"))


def _suffixes(texts: DataFrame) -> DataFrame:
    """From (th, text, at): one row per kept suffix: the hash of the next SHARED
    words, the codes of the words after them, and of the words before in
    reverse, as far as its passages reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            th, at = b.column(0).to_numpy(), b.column(2)
            for first, part in pieces(text_bytes(b.column(1))):
                out: list[list] = [[], [], [], [], []]
                for i, t in enumerate(part, first):
                    hashes = Words([t], SPACED).hashes()
                    g = grams(hashes, SHARED).view(np.int64)
                    code = (hashes >> np.uint64(64 - 8 * CODE)).astype(f">u{CODE}")
                    turned = code[::-1].copy()
                    for mark in sorted(at[i].as_py()):
                        rest, most = divmod(mark, WINDOW)
                        p, fewest = divmod(rest, WINDOW)
                        out[0].append(int(g[p]))
                        out[1].append(code[p + SHARED:p - fewest + LEAST].tobytes())
                        out[2].append(turned[len(code) - p:len(code) - p + most].tobytes())
                        out[3].append(int(th[i]))
                        out[4].append(p)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()),
                         pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())], names=["g", "ahead", "behind", "th", "pos"])

    return texts.mapInArrow(run, "g bigint, ahead binary, behind binary, th bigint, pos bigint")


def _common(a: bytes, b: bytes) -> int:
    """Words that two coded sequences share from their beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // CODE
    x = np.frombuffer(a, f"<u{CODE}", n // CODE) != np.frombuffer(b, f"<u{CODE}", n // CODE)
    return int(x.argmax())


def _passages(key: tuple[int, bytes, bytes], shared: int) -> list[tuple[int, int]]:
    """(hash, words before the suffix) of each passage of a suffix that has at
    most ``shared`` words from the suffix on."""
    g, ahead, behind = key
    most = len(behind) // CODE
    fewest = max(WINDOW - 1 - len(ahead) // CODE, LEAST - shared)
    return [(int.from_bytes(blake2b(struct.pack(">qB", g, k) + behind[:k * CODE] + ahead[:(WINDOW - 1 - k) * CODE], digest_size=8).digest(),
                            "big", signed=True), k) for k in range(fewest, most + 1)]


class _Run:
    """Equal suffixes; those of one text only are held, at most as many as it has."""

    def __init__(self, key: tuple[int, bytes, bytes], shared: int):
        self.key, self.shared = key, shared  # words shared with the run before
        self.lo = self.hi = None
        self.held: list[int] = []

    def add(self, th: int, pos: int) -> list[tuple[int, int, int]]:
        """Spans known by now."""
        if self.lo is None:
            self.lo = self.hi = th
        if self.lo == self.hi == th:
            self.held.append(pos)
            return []
        known = [(self.lo, p) for p in self.held] + [(th, pos)]
        self.lo, self.hi, self.held = min(self.lo, th), max(self.hi, th), []
        left, right = len(self.key[2]) // CODE, SHARED + len(self.key[1]) // CODE
        return [(t, p - left, p + right) for t, p in known]

    def unlike(self, shared: int) -> list[tuple[int, int, int, int | None]]:
        """(hash, least and most text, start) of the passages that unlike
        suffixes may share; ``shared`` words with the run after."""
        out = []
        for h, k in _passages(self.key, max(self.shared, shared)):
            out += [(h, self.lo, self.hi, p - k) for p in self.held] or [(h, self.lo, self.hi, None)]
        return out


_FOUND_SCHEMA = "h bigint, lo bigint, hi bigint, start bigint, stop bigint"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes of one range to spans (lo, start, stop) of equal suffixes,
    and passages (h, lo, hi, start) that unlike ones may share.  What lies
    beyond the range is not known, so it may share all."""

    def batch(spans: list[tuple], some: list[tuple]) -> pa.RecordBatch:
        n, m = [None] * len(spans), [None] * len(some)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (n + [s[0] for s in some], [s[0] for s in spans] + [s[1] for s in some],
                                               n + [s[2] for s in some], [s[1] for s in spans] + [s[3] for s in some],
                                               [s[2] for s in spans] + m)], names=["h", "lo", "hi", "start", "stop"])

    run = None
    for b in batches:
        spans: list[tuple] = []
        some: list[tuple] = []
        for g, ahead, behind, th, pos in zip(*[b.column(c).to_pylist() for c in range(5)], strict=True):
            key = (g, ahead, behind)
            if run is None:
                run = _Run(key, LEAST)
            elif key != run.key:
                shared = SHARED + _common(ahead, run.key[1]) if g == run.key[0] else 0
                some += run.unlike(shared)
                run = _Run(key, shared)
            spans += run.add(th, pos)
        if spans or some:
            yield batch(spans, some)
    if run is not None:
        yield batch([], run.unlike(LEAST))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(th, spans) to one row per maximal span."""
    for b in batches:
        out: list[tuple[int, int, int]] = []
        for th, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            begin = stop = None
            for s in sorted((x["start"], x["stop"]) for x in spans):
                if stop is not None and s[0] <= stop:
                    stop = max(stop, s[1])
                    continue
                if stop is not None:
                    out.append((th, begin, stop))
                begin, stop = s
            if stop is not None:
                out.append((th, begin, stop))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(3)],
                                             names=["th", "start", "stop"])


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word, n_words): every passage of LEAST words or
    more that another document holds too (end exclusive; ``n_words`` of the document)."""
    survey = saved(_survey(docs))
    rows = survey.where("pos is null").select("doc_id", "th", "n")
    anchors = survey.where("pos is not null").select("th", "pos", "g")
    # a table of its own, so that the join deals the suffixes anew and a hot hash can be split
    shared = saved(anchors.groupBy("g").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where("lo != hi").select("g"))
    spots = anchors.join(shared, "g", "left_semi").groupBy("th").agg(F.collect_set("pos").alias("at"))

    # one document of each text; equal ids with equal texts are one document
    ids = rows.groupBy("th").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.max("n").alias("n"),
                                 F.count(F.lit(1)).alias("rows"), F.count("doc_id").alias("named"))
    holders = spots.join(ids.select("th", "least"), "th").select(F.col("th").alias("__sd_th"), "least", "at")
    texts = (docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                   F.xxhash64("text").alias("th"), "text")
             .join(holders, (F.col("th") == F.col("__sd_th")) & F.col("doc_id").eqNullSafe(F.col("least")))
             .select("th", "text", "at"))
    order = ["g", "ahead", "behind", "th", "pos"]
    found = saved(_suffixes(texts).repartitionByRange(*order).sortWithinPartitions(*order)
                  .mapInArrow(_neighbours, _FOUND_SCHEMA))
    equal = found.where("h is null").select(F.col("lo").alias("th"), "start", "stop")
    passages = found.where("h is not null")
    again = saved(passages.groupBy("h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo != hi").select("h"))
    unlike = (passages.where("start is not null").join(again, "h", "left_semi")
              .select(F.col("lo").alias("th"), "start", (F.col("start") + LEAST).alias("stop")))
    whole = (ids.where((F.col("n") >= LEAST) & ((F.col("least") != F.col("most"))
                                               | ((F.col("named") < F.col("rows")) & (F.col("rows") > 1))))
             .select("th", F.lit(0).cast("long").alias("start"), F.col("n").alias("stop")))
    spans = (equal.unionByName(unlike).unionByName(whole).distinct()
             .groupBy("th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
             .mapInArrow(_merged, "th bigint, start bigint, stop bigint"))
    return (rows.join(spans, "th")
            .select("doc_id", F.col("start").alias("start_word"), F.col("stop").alias("end_word"), F.col("n").alias("n_words"))
            .distinct())
