"""BPE encoding and decoding with a contiguous rank array per word.

A word's parts are held as an array of part ids and an array of the ranks of
adjacent pairs.  The smallest rank (the leftmost of equal ones) is found by a
scan, the boundary is deleted from both arrays, and only the ranks of the two
neighbouring pairs are looked up anew.  Scans are linear, so words of more than
``LONG_WORD`` parts, where that would be quadratic, keep the same order of
merges with a heap over linked parts.  Words repeat, so each task remembers up
to ``REMEMBERED`` words and then starts afresh.

The vocabulary file (``tokenizers`` JSON: BPE with an end-of-word mark, NFC and
lower case, white space dropped) is read once by the driver from the path given
and sent along with the tasks; it is never copied into the library.  Special
tokens found in a text become their ids, as the file asks.

Defined results: null text is the empty text, which has no ids and decodes to
the empty text; a text of any length is encoded whole; repeated rows get equal
results; other columns are carried along; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from tidepool.llm.charclass import lower_differences, python_pattern
from tidepool.llm.textvec import append_columns

LONG_WORD = 256
REMEMBERED = 200_000
_NONE = 1 << 60


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 characters stand for themselves, the others, in order,
    for code points from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@dataclass
class Tokenizer:
    tokens: dict[int, str]  # id -> token
    first: list[int]  # byte -> id of the part
    last: list[int]  # byte -> id of the part that ends a word
    merges: dict[tuple[int, int], tuple[int, int]]  # pair of ids -> (rank, id)
    special: dict[str, int]
    splits: list[str]  # patterns for texts of ASCII, of code points below 0x10000, and of any
    lower: dict[int, str]  # lower case where the library's table has another than Python's
    _known: dict = field(default_factory=dict, repr=False)
    _patterns: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_known": {}, "_patterns": None}

    def word_ids(self, word: bytes) -> list[int]:
        parts = [self.first[b] for b in word[:-1]] + [self.last[word[-1]]]
        return self._merge_scan(parts) if len(parts) <= LONG_WORD else self._merge_heap(parts)

    def _merge_scan(self, parts: list[int]) -> list[int]:
        get, none = self.merges.get, (_NONE, -1)
        pairs = [get(p, none) for p in zip(parts, parts[1:])]
        ranks = [p[0] for p in pairs]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            parts[i:i + 2] = [pairs[i][1]]
            del ranks[i], pairs[i]
            for j in (i - 1, i):
                if 0 <= j < len(ranks):
                    pairs[j] = get((parts[j], parts[j + 1]), none)
                    ranks[j] = pairs[j][0]
        return parts

    def _merge_heap(self, parts: list[int]) -> list[int]:
        n, get = len(parts), self.merges.get
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m[0], i, parts[i], parts[i + 1], m[1]) for i in range(n - 1) if (m := get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, to = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue  # one of the two has been merged since
            parts[i], parts[j] = to, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (m := get((parts[x], parts[y]))):
                    heapq.heappush(heap, (m[0], x, parts[x], parts[y], m[1]))
        return [p for p in parts if p >= 0]

    def _pieces(self, text: str):
        """(special id or None, plain text) in order."""
        marks = self.patterns()[0]
        at = 0
        for m in marks.finditer(text) if marks else ():
            yield None, text[at:m.start()]
            yield self.special[m.group()], ""
            at = m.end()
        yield None, text[at:]

    def patterns(self) -> tuple:
        if self._patterns is None:
            marks = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
            odd = re.compile(f"[{''.join(map(chr, self.lower))}]" if self.lower else "(?!)")
            self._patterns = re.compile(marks) if marks else None, [re.compile(p).findall for p in self.splits], odd.search
        return self._patterns

    def _learn(self, word: str) -> tuple[int, str, str]:
        ids = self.word_ids(word.encode())
        e = len(ids), " ".join(map(str, ids)), " ".join([self.tokens[i] for i in ids])
        if len(word) <= LONG_WORD:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[word] = e
        return e

    def _entries(self, text: str) -> list[tuple[int, str, str]]:
        """Per word: (number of ids, ids joined by a space, tokens joined by a space)."""
        (_, splits, odd), known, learn = self.patterns(), self._known.get, self._learn
        out: list[tuple[int, str, str]] = []
        for mark, plain in self._pieces(text):
            if mark is not None:
                out.append((1, str(mark), self.tokens[mark]))
            elif plain:
                kind = 0
                if plain.isascii():
                    plain = plain.lower()
                else:
                    plain = unicodedata.normalize("NFC", plain)
                    if odd(plain):
                        plain = plain.translate(self.lower)
                    # each character lower-cased by itself, so no final-sigma rule
                    plain = plain.replace("Σ", "σ").lower()
                    kind = 1 if 2 * len(plain) == len(plain.encode("utf-16-le", "surrogatepass")) else 2
                out += [known(w) or learn(w) for w in splits[kind](plain)]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self._entries(text) for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space; the file names no decoder, so byte characters and word ends stay."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, sha256 of the ids, sha256 of the decoded text."""
        found = self._entries(text)
        ids = " ".join([e[1] for e in found])
        decoded = " ".join([e[2] for e in found])
        return (sum([e[0] for e in found]), hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest())


def load(path: str) -> Tokenizer:
    """Read a vocabulary file; raises if it asks for steps other than those above."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
        raise ValueError(f"{path} is not a lower-casing word BPE file")
    vocab, suffix = model["vocab"], model["end_of_word_suffix"]
    chars = byte_chars()
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    return Tokenizer({**{i: t for t, i in vocab.items()}, **{i: t for t, i in special.items()}},
                     [vocab[c] for c in chars], [vocab[c + suffix] for c in chars], merges, special,
                     [python_pattern(split, top) for top in (0x7F, 0xFFFF, 0x10FFFF)], lower_differences())


def token_digests(docs: DataFrame, tokenizer: Tokenizer, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256."""

    def compute():
        def batch(b: pa.RecordBatch) -> list[pa.Array]:
            rows = [tokenizer.digests(t.as_py() or "") for t in b.column(b.schema.get_field_index(text))]  # one text at a time
            n, ids, decoded = zip(*rows, strict=True)
            return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]

        return batch

    return append_columns(docs, [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                                 StructField("decoded_sha256", StringType())], compute)
