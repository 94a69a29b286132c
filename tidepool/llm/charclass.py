"""Letters, numbers and white space as the tokenizers library's patterns see them.

The library's character table is its own, and newer than Python's.  One call of
its byte-level pre-tokenizer over all code points in order cuts them into runs
of one class; a second one tells the class of each run.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: Code points below this are classed one by one: the space there joins the piece after it.
_SINGLE = 0x80


def _class_text(ranges: list[tuple[int, int]], top: int) -> str:
    return "".join(f"\\U{a:08x}-\\U{min(b, top):08x}" for a, b in ranges if a <= top)


@cache
def classes() -> dict[str, list[tuple[int, int]]]:
    """Ranges of the library's ``L`` (letters), ``N`` (numbers) and ``s`` (white space)."""
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    rest = [*range(_SINGLE, 0xD800), *range(0xE000, 0x110000)]
    runs = [(c, c) for c in range(_SINGLE)] + [(rest[a], rest[b - 1]) for _, (a, b) in cut("".join(map(chr, rest)))]
    # a run over the surrogates' gap is one range in the class: no text holds them
    found: dict[str, list[tuple[int, int]]] = {"L": [], "N": [], "s": []}
    for a, b in runs:
        joined = [len(cut(lead + chr(a))) == 1 for lead in "a1!"]
        if joined[0]:
            found["L"].append((a, b))
        elif joined[1]:
            found["N"].append((a, b))
        elif not joined[2]:
            found["s"].append((a, b))
    return found


def python_pattern(pattern: str, top: int = 0x10FFFF) -> str:
    r"""``pattern`` for Python's ``re``, with ``\p{L}``, ``\p{N}``, ``\s`` and ``\S`` spelt out by that table,
    for texts of code points up to ``top`` (ranges left out make it faster)."""
    of = {k: _class_text(v, top) for k, v in classes().items()}
    out, inside, i = [], False, 0
    while i < len(pattern):
        for mark, ranges, negative in ((r"\p{L}", of["L"], False), (r"\p{N}", of["N"], False), (r"\s", of["s"], False),
                                       (r"\S", of["s"], True)):
            if pattern.startswith(mark, i):
                if inside and negative:
                    raise ValueError(f"{mark} inside a class: {pattern}")
                out.append(ranges if inside else f"[{'^' * negative}{ranges}]")
                i += len(mark)
                break
        else:
            c = pattern[i]
            if c == "\\":
                out.append(pattern[i:i + 2])
                i += 2
                continue
            inside = c == "[" or inside and c != "]"
            out.append(c)
            i += 1
    return "".join(out)


@cache
def lower_differences() -> dict[int, str]:
    """Code points that the library lower-cases otherwise than ``str.lower`` does, with what it makes of them."""
    from tokenizers import normalizers

    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and c != 10]
    theirs = normalizers.Lowercase().normalize_str("\n".join(chars)).split("\n")
    return {ord(c): x for c, x in zip(chars, theirs, strict=True) if c.lower() != x}


OTHER, LETTER, NUMBER, SPACE, END = range(5)


@cache
def class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for name, kind in (("L", LETTER), ("N", NUMBER), ("s", SPACE)):
        for a, b in classes()[name]:
            table[a:b + 1] = kind
    return table


def byte_kinds(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 belongs to."""
    kinds = table[:256][points]
    lead = np.flatnonzero(points >= 0xC0)
    size = 2 + (points[lead] >= 0xE0) + (points[lead] >= 0xF0)
    code = points[lead].astype(np.int32) & 0x7F >> size
    after = [size > k for k in (1, 2, 3)]
    for k, more in enumerate(after, 1):
        code[more] = code[more] << 6 | points[lead[more] + k] & 0x3F
    kind = table[code]
    kinds[lead] = kind
    for k, more in enumerate(after, 1):
        kinds[lead[more] + k] = kind[more]
    return kinds


def cut(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    r"""Where the pieces of the byte-level pattern begin in UTF-8 bytes of the
    given classes (``END`` between texts is a piece of its own):
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``."""
    n = len(kinds)
    begins = np.ones(n + 1, dtype=bool)
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:n])
    begins[1:n] |= kinds[1:] == END
    run = np.flatnonzero(begins)
    first, after = run[:-1], run[1:]
    # of white space before a word the last character stands apart, and a plain space joins the word
    kind = kinds[first]
    joined = after[:-1][(kind[:-1] == SPACE) & (kind[1:] < SPACE)]
    last = joined - 1
    while (inside := points[last] & 0xC0 == 0x80).any():
        last = last - inside
    begins[last] = True
    begins[joined[points[joined - 1] == 0x20]] = False
    # an apostrophe that begins a piece takes the letters of a short form
    at = first[:-1][(kind[:-1] == OTHER) & (kind[1:] == LETTER) & (after[:-1] - first[:-1] == 1)]
    at = at[(points[at] == 0x27) & begins[at]]
    c1 = points[at + 1]
    c2 = np.where((at + 2 < n) & (kinds[np.minimum(at + 2, n - 1)] == LETTER), points[np.minimum(at + 2, n - 1)], 0)
    s, t, m, d, r, v, e, l = map(ord, "stmdrvel")
    one = (c1 == s) | (c1 == t) | (c1 == m) | (c1 == d)
    two = ~one & (((c1 == r) | (c1 == v)) & (c2 == e) | (c1 == l) & (c2 == l))
    begins[at[one | two] + 1] = False
    begins[at[one] + 2] = True
    begins[at[two] + 3] = True
    return np.flatnonzero(begins[:n])
