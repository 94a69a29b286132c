"""A wavelet matrix over token ids: bit-planes with rank and select directories.

Plane 0 holds every id's highest bit in text order.  Each plane's order is the
one above it, stably parted into those with bit 0 there and then those with bit
1, so one rank on each plane follows a token down and one select on each leads
back up.  A plane is its bits in 64-bit words and a directory with the number
of ones before every ``BLOCK`` bits; counts inside a block are population counts
of at most eight words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bits of a directory block, and 64-bit words of one.
BLOCK = 512
_WORDS = BLOCK // 64
#: Positions that select works on at once.
_AT_ONCE = 1 << 14


@dataclass
class Plane:
    words: np.ndarray  # uint64, whole blocks
    before: np.ndarray  # uint32: ones before each block, and in all
    n: int

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        raw = np.zeros(-(-max(len(bits), 1) // BLOCK) * BLOCK // 8, dtype=np.uint8)
        raw[:len(packed)] = packed
        words = raw.view("<u8")
        ones = np.bitwise_count(words).reshape(-1, _WORDS).sum(axis=1, dtype=np.uint32)
        return cls(words, np.concatenate(([0], np.cumsum(ones))).astype("<u4"), len(bits))

    @property
    def zeros(self) -> int:
        return self.n - int(self.before[-1])

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        i = np.asarray(i, dtype=np.int64)
        block = np.minimum(i // BLOCK, len(self.before) - 2)
        inside = i - block * BLOCK
        left = inside[:, None] - 64 * np.arange(_WORDS)
        keep = np.where(left >= 64, ~np.uint64(0), (np.uint64(1) << np.clip(left, 0, 63).astype(np.uint64)) - np.uint64(1))
        words = self.words.reshape(-1, _WORDS)[block] & np.where(left <= 0, np.uint64(0), keep)
        return self.before[block].astype(np.int64) + np.bitwise_count(words).sum(axis=1, dtype=np.int64)

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th (from 0) bit that is ``one``."""
        k = np.asarray(k, dtype=np.int64)
        parts = [self._select(k[a:a + _AT_ONCE], one) for a in range(0, len(k), _AT_ONCE)]
        return np.concatenate(parts) if parts else k

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        before = self.before.astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before, k, side="right") - 1
        words = self.words.reshape(-1, _WORDS)[block]
        words = words if one else ~words
        upto = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        left = k - before[block]
        word = (upto <= left[:, None]).sum(axis=1)
        rows = np.arange(len(k))
        left -= np.where(word > 0, upto[rows, word - 1], 0)
        bits = (words[rows, word][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        place = (np.cumsum(bits, axis=1, dtype=np.int64) <= left[:, None]).sum(axis=1)
        return block * BLOCK + word * 64 + place


@dataclass
class WaveletMatrix:
    planes: list[Plane]
    n: int

    @classmethod
    def of(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        """Of ids below 2 ** width."""
        if not 1 <= width <= 32 or len(ids) and int(ids.max()) >> width:
            raise ValueError(f"ids need more than {width} bits")
        a, planes = ids.astype(np.uint16 if width <= 16 else np.uint32), []
        for shift in range(width - 1, -1, -1):
            bit = (a & a.dtype.type(1 << shift)) != 0
            planes.append(Plane.of(bit))
            a = np.concatenate((a.compress(~bit), a.compress(bit)))
        return cls(planes, len(ids))

    def ids(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        a = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for shift, plane in enumerate(reversed(self.planes)):
            bit, up = plane.bits(), np.empty_like(a)
            up[np.flatnonzero(~bit)] = a[:plane.zeros]
            up[np.flatnonzero(bit)] = a[plane.zeros:] | a.dtype.type(1 << shift)
            a = up
        return a

    def access(self, at: np.ndarray) -> np.ndarray:
        """Ids at the places ``at``, each below n, without unpacking the rest."""
        at, out = np.asarray(at, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        for plane in self.planes:
            bit, ones = plane.get(at), plane.rank1(at)
            at = np.where(bit, plane.zeros + ones, at - ones)
            out = out << 1 | bit
        return out

    def _down(self, token: int, bounds: np.ndarray) -> np.ndarray:
        """Where the bounds of a range of places fall among the ids equal to ``token`` on the lowest order."""
        for k, plane in enumerate(self.planes):
            ones = plane.rank1(bounds)
            bounds = plane.zeros + ones if token >> (len(self.planes) - 1 - k) & 1 else bounds - ones
        return bounds

    def rank(self, token: int, upto: int | None = None) -> int:
        """How often ``token`` is among the first ``upto`` ids (all, if none)."""
        if token < 0 or token >> len(self.planes):
            return 0
        a, b = self._down(token, np.array([0, self.n if upto is None else upto]))
        return int(b - a)

    def places(self, token: int) -> np.ndarray:
        """Every place of ``token``, ascending: one select on each plane."""
        if token < 0 or token >> len(self.planes):
            return np.empty(0, np.int64)
        a, b = self._down(token, np.array([0, self.n]))
        at = np.arange(a, b)
        for shift, plane in enumerate(reversed(self.planes)):
            at = plane.select(at - plane.zeros, True) if token >> shift & 1 else plane.select(at, False)
        return at

    def to_bytes(self) -> tuple[bytes, bytes]:
        """(planes, directories), each of all planes one after the other."""
        return b"".join(p.words.tobytes() for p in self.planes), b"".join(p.before.tobytes() for p in self.planes)

    @classmethod
    def from_bytes(cls, planes: bytes, before: bytes, n: int, width: int) -> WaveletMatrix:
        words = np.frombuffer(planes, dtype="<u8").reshape(width, -1)
        counts = np.frombuffer(before, dtype="<u4").reshape(width, -1)
        return cls([Plane(w, c, n) for w, c in zip(words, counts, strict=True)], n)
