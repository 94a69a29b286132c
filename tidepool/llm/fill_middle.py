"""Fill-in-middle transformation with a Fenwick tree over text blocks.

A text's UTF-8 bytes are cut into blocks of ``BLOCK`` bytes.  Two Fenwick trees
over the blocks hold how many units end in each block and how many code points
begin there.  The end of unit k is found by one binary-lifting descent of the
unit tree, which sums the code points of the blocks it passes on the way; only
the block that is left is looked through for the boundary itself.  Units are
lines: ``[^\\n]*\\n|[^\\n]+``.

A document's two cuts, and whether and in which form it is transformed, follow
from a hash of its id, so a retried task gives the same rows and no row needs
another: the work is one pass without a shuffle.

Defined results: null text is the empty text; an empty text, a text that holds
one of the marks, and a text not drawn are ``plain`` (output is the text, the
two counts are null); a null id counts as the empty text in the hash; a text of
any length is cut whole (its trees take 16 bytes a block); repeated rows get
equal results; other columns are carried along, columns named like the results
are replaced; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tidepool.llm.textvec import append_columns, text_bytes

#: Bytes of a block.
BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_P, _S, _M = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
_NEWLINE = 10


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The tree of ``counts``: entry i (from 1 on) is the sum of the lowbit(i) counts that end at the i-th."""
    upto = np.concatenate(([0], np.cumsum(counts)))
    i = np.arange(len(upto))
    return upto - upto[i - (i & -i)]


class Blocks:
    """Where the lines of one text end, in bytes and in code points."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self.raw, self.block = np.frombuffer(text, dtype=np.uint8), block
        first = np.arange(0, len(self.raw), block)
        ends, begins = self.raw == _NEWLINE, (self.raw & 0xC0) != 0x80
        per_unit, per_char = ((np.add.reduceat(x, first, dtype=np.int64) if len(first) else np.empty(0, np.int64))
                              for x in (ends, begins))
        self.ended, self.n_chars = int(per_unit.sum()), int(per_char.sum())
        self.units, self.chars = fenwick(per_unit).tolist(), fenwick(per_char).tolist()
        #: Lines, the last one also without its newline.
        self.n = self.ended + (len(self.raw) > 0 and self.raw[-1] != _NEWLINE)

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first k lines."""
        if k <= 0:
            return 0, 0
        if k > self.ended:
            return len(self.raw), self.n_chars
        at, left, chars = 0, k, 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step:
            to = at + step
            if to < len(self.units) and self.units[to] < left:
                at, left, chars = to, left - self.units[to], chars + self.chars[to]
            step >>= 1
        here = self.raw[at * self.block:(at + 1) * self.block]
        end = int(np.flatnonzero(here == _NEWLINE)[left - 1]) + 1
        return at * self.block + end, chars + int(np.count_nonzero((here[:end] & 0xC0) != 0x80))


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """The first four 32-bit numbers of sha256 of ``seed:doc_id``."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def rearrange(doc_id: int | None, text: bytes, seed: int, rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    lines = Blocks(text)
    if not text or h3 % 100 >= rate or any(m in text for m in (_P, _S, _M)):
        return lines.n, "plain", None, None, text
    a, b = sorted((h1 % (lines.n + 1), h2 % (lines.n + 1)))
    (x, before), (y, upto) = lines.cut(a), lines.cut(b)
    prefix, middle, suffix = text[:x], text[x:y], text[y:]
    if h4 % 100 < spm:
        return lines.n, "spm", before, upto - before, b"".join((_S, suffix, _P, prefix, _M, middle))
    return lines.n, "psm", before, upto - before, b"".join((_P, prefix, _S, suffix, _M, middle))


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, text: str = "text",
              id_col: str = "doc_id") -> DataFrame:
    """``docs`` with n (lines), form (``plain``, ``psm`` or ``spm``),
    prefix_chars, middle_chars and output.  ``rate`` of 100 texts are
    transformed, ``spm`` of 100 of these with the suffix first."""
    if not (0 <= rate <= 100 and 0 <= spm <= 100):
        raise ValueError("rate and spm are shares of 100")

    def compute():
        def batch(b: pa.RecordBatch) -> list[pa.Array]:
            ids = b.column(b.schema.get_field_index(id_col)).to_pylist()
            texts = text_bytes(b.column(b.schema.get_field_index(text)))
            rows = [rearrange(i, t or b"", seed, rate, spm) for i, t in zip(ids, texts, strict=True)]
            n, form, before, between, out = zip(*rows, strict=True)
            return [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                    pa.array(between, pa.int64()), pa.array(out, pa.binary()).view(pa.string())]

        return batch

    return append_columns(docs, [StructField("n", LongType()), StructField("form", StringType()),
                                 StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                                 StructField("output", StringType())], compute)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text an output was made of.  The marks are not in the text and begin
    with a character they hold once, so the first of each in turn is the one set."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def parts(marks: list[str]) -> list[Column]:
        """The text after each mark, up to the next one."""
        rest, found = F.substring(out, len(marks[0]) + 1, 2 ** 31 - 1), []
        for m in marks[1:]:
            head = F.substring_index(rest, m, 1)
            found.append(head)
            rest = F.substring(rest, F.length(head) + F.lit(len(m) + 1), F.lit(2 ** 31 - 1))
        return [*found, rest]

    psm, spm = parts([PREFIX, SUFFIX, MIDDLE]), parts([SUFFIX, PREFIX, MIDDLE])
    return (F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
            .when(form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(out))


def digests(docs: DataFrame, **settings) -> DataFrame:
    """``transform`` with the sha256 of the output and of the text restored from it, without the texts."""
    out = transform(docs, **settings)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))
