"""Sorted lists of values as rows of a table, and their union per key.

A list of integers is one binary value: the differences of its sorted values,
seven bits a byte.  Lists of other types are arrays.  A long list is several
rows of at most ``PART`` values, so no row and no task grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

#: Most values of one row; values that a task handles at a time.
PART, PIECE = 1_024, 500_000

#: Types whose lists are packed.
INTEGERS = (ByteType, ShortType, IntegerType, LongType)

_U = np.uint64


def pack(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Lists of sorted int64, each beginning at one of ``starts``, as binary values."""
    d = values.astype(np.int64).view(_U)
    gaps = d.copy()
    gaps[1:] -= d[:-1]
    gaps[starts] = d[starts]
    width = np.ones(len(gaps), np.int64)
    for k in range(1, 10):
        width += gaps >= _U(1) << _U(7 * k)
    end = np.cumsum(width)
    flat = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    for k in range(int(width.max(initial=0))):
        has = np.flatnonzero(width > k)
        more = np.where(width[has] > k + 1, 128, 0)
        flat[(end - width)[has] + k] = ((gaps[has] >> _U(7 * k)) & _U(127)).astype(np.int64) | more
    offsets = np.concatenate(((end - width)[starts], [len(flat)])).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def unpack(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of values of each list, all values) of ``pack``."""
    offsets = np.frombuffer(lists.buffers()[1], np.int32, len(lists) + 1, 4 * lists.offset).astype(np.int64)
    flat = np.frombuffer(lists.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    last = np.flatnonzero(flat < 128)
    counts = np.diff(np.searchsorted(last, offsets - offsets[0]))  # of the values that end before each list
    if not len(last):
        return counts, np.zeros(0, np.int64)
    first = np.concatenate(([0], last[:-1] + 1))
    gaps = (flat[first] & 127).astype(_U)
    width = last - first + 1
    for k in range(1, int(width.max())):
        has = np.flatnonzero(width > k)
        gaps[has] |= (flat[first[has] + k] & 127).astype(_U) << _U(7 * k)
    sums = np.cumsum(gaps)
    begin = (np.cumsum(counts) - counts)[counts > 0]
    base = sums[begin] - gaps[begin]
    return counts, (sums - np.repeat(base, counts[counts > 0])).view(np.int64)


def _sorted_once(of: np.ndarray, codes: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray]:
    """(of, codes) sorted by both, every pair once; ``of`` is below ``names``.
    Where both fit 64 bits they are sorted as one number."""
    if not len(codes):
        return of, codes
    low = int(codes.min())
    bits = (int(codes.max()) - low).bit_length()
    if bits + names.bit_length() > 64:
        order = np.lexsort((codes, of))
        of, codes = of[order], codes[order]
        once = np.ones(len(of), bool)
        once[1:] = (codes[1:] != codes[:-1]) | (of[1:] != of[:-1])
        return of[once], codes[once]
    base = _U(low % (1 << 64))
    both = of.astype(_U) << _U(bits) | codes.view(_U) - base
    both.sort()
    once = np.ones(len(both), bool)
    once[1:] = both[1:] != both[:-1]
    both = both[once]
    return (both >> _U(bits)).astype(np.int64), ((both & _U((1 << bits) - 1)) + base).view(np.int64)


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each row differs from the one before (the first: yes)."""
    new = np.ones(len(column), bool)
    if len(column) > 1:
        new[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return new


def lists_of(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, list, n, gap): the values of each non-null key in rows of at most
    ``PART``.  ``n`` is their number, repeats that follow each other counted
    once; ``gap`` tells whether a null is among them."""
    integer = isinstance(rows.schema[value].dataType, INTEGERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys, values = b.column(0), b.column(1)
            new = _changes(keys)
            null = values.is_null().to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(new)
            place = np.arange(b.num_rows) - begin[np.cumsum(new) - 1]
            start = np.flatnonzero(place % PART == 0)
            gap = np.logical_or.reduceat(null, start)
            row = np.cumsum(place % PART == 0) - 1
            keep = ~null
            if integer:
                v = values.filter(pa.array(keep)).cast(pa.int64()).to_numpy()
                r = row[keep]
                fresh = np.ones(len(v), bool)
                fresh[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
                v, r = v[fresh], r[fresh]
                n = np.bincount(r, minlength=len(start))
                lists = pack(v, (np.cumsum(n) - n)[n > 0])
                lists = lists.take(pa.array(np.where(n > 0, np.cumsum(n > 0) - 1, 0), mask=n == 0)).fill_null(b"")
            else:
                n = np.bincount(row[keep], minlength=len(start))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), values.filter(pa.array(keep)))
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(start)), lists, pa.array(n.astype(np.int64)), pa.array(gap)],
                                             names=[key, "list", "n", "gap"])

    as_list = "binary" if integer else f"array<{rows.schema[value].dataType.simpleString()}>"
    sorted_rows = (rows.where(F.col(key).isNotNull()).select(key, value)
                   .repartition(key).sortWithinPartitions(key, value))
    return sorted_rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, list {as_list}, n bigint, gap boolean")


def union_per_key(lists: DataFrame, key: str, value: str, kind: DataType, most: int, nulls: bool) -> DataFrame:
    """(key, pair, n, value): the values of each key's lists (``lists_of``), every one once.

    A key's values meet in one task, which holds at most ``most`` of them
    beyond a piece of ``PIECE``, and give one row with their number ``n`` and
    ``pair`` false.  The values of a key of more leave as rows (``pair`` true,
    ``n`` 1) that may still repeat.  ``nulls``: a null is a value of its own."""
    arrow = to_arrow_type(kind)
    integer = isinstance(kind, INTEGERS)

    def rows_of(keys: pa.Array, pair: bool, n: np.ndarray, values: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(keys), pair)), pa.array(n.astype(np.int64)), values],
                                          names=[key, "pair", "n", value])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.array([], pa.int64() if integer else arrow)
        held, kept, held_gap, spread = None, none, False, False  # the open key, its values, whether they leave as rows
        for b in batches:
            if not b.num_rows:
                continue
            piece = np.cumsum(b.column(2).to_numpy()) // PIECE
            edges = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), b.num_rows]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                keys, lists_, gap = (b.column(c).slice(i, j - i) for c in (0, 1, 3))
                if integer:
                    counts, flat = unpack(lists_)
                    values = pa.array(flat)
                else:
                    counts, values = pc.list_value_length(lists_).to_numpy(), lists_.flatten()
                new = _changes(keys)
                names = keys.take(pa.array(np.flatnonzero(new)))
                of = np.cumsum(new) - 1
                if held is not None:
                    if not held.equals(keys[0]):
                        of, names = of + 1, pa.concat_arrays([pa.array([held.as_py()], keys.type), names])
                gaps = np.bincount(of, gap.to_numpy(zero_copy_only=False), len(names)) > 0
                if held is not None:
                    gaps[0] |= held_gap
                values = pa.concat_arrays([kept, values])
                of = np.concatenate((np.zeros(len(kept), np.int64), np.repeat(of, counts)))
                if integer:
                    of, codes = _sorted_once(of, values.to_numpy(), len(names))
                else:
                    coded = values.dictionary_encode()
                    of, codes = _sorted_once(of, coded.indices.to_numpy().astype(np.int64), len(names))
                value_of = pa.array if integer else coded.dictionary.take
                n = np.bincount(of, minlength=len(names))
                last = len(names) - 1
                leaves = np.zeros(len(names), bool)
                leaves[0] |= spread
                spread = bool(leaves[last] or n[last] > most)
                leaves[last] |= spread
                counted = ~leaves
                counted[last] = False
                yield rows_of(names.filter(pa.array(counted)), False, (n + (gaps & nulls))[counted], pa.nulls(int(counted.sum()), arrow))
                out = leaves[of]
                if leaves.any():
                    yield rows_of(names.take(pa.array(of[out])), True, np.ones(int(out.sum())), value_of(codes[out]).cast(arrow))
                    lost = leaves & gaps & nulls
                    yield rows_of(names.filter(pa.array(lost)), True, np.ones(int(lost.sum())), pa.nulls(int(lost.sum()), arrow))
                held = names[last]
                kept, held_gap = (none, False) if spread else (value_of(codes[of == last]), bool(gaps[last]))
        if held is not None and not spread:
            yield rows_of(pa.array([held.as_py()], held.type), False, np.array([len(kept) + (held_gap and nulls)]), pa.nulls(1, arrow))

    key_type = lists.schema[key].dataType.simpleString()
    return (lists.select(key, "list", "n", "gap").repartition(key).sortWithinPartitions(key)
            .mapInArrow(run, f"{key} {key_type}, pair boolean, n bigint, {value} {kind.simpleString()}"))
