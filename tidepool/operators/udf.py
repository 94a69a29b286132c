"""The user-function surface.

Built-in expressions come first everywhere in this package; these wrappers
are for logic a user brings as Python code.  All of them move data between
the JVM and Python in Arrow batches, never one pickled row at a time, and
the per-row Python inside stays a small helper.
"""

from __future__ import annotations

import operator
from functools import reduce
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


# ------------------------------------------------------------- X1: row -> rows
@udtf(returnType="word: string", useArrow=True)
class SplitWords:
    """Row function with 0..n outputs: the Python split rule (keeps empties)."""

    def eval(self, text: str | None):
        if text is None:
            return
        for w in text.split(" "):
            yield (w,)


def udtf_tokens(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per token through the Python UDTF (lateral join)."""
    return df.lateralJoin(SplitWords(F.col(text).outer())).select(*keep, "word")


#: Bytes of text that a task splits at a time.
SPLIT_BYTES = 1 << 20


def text_pieces(batch: pa.RecordBatch, text: int, size: int = SPLIT_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``size`` bytes in column ``text``, one row at least."""
    if not batch.num_rows:
        return
    before = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(before[1:] != before[:-1]) + 1).tolist(), batch.num_rows]
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(i, j - i)


@F.arrow_udtf(returnType="id bigint, word string")
class SplitWordsArrow:
    """The same table function, vectorised: each call gets a whole Arrow
    batch of ``(id, text)`` rows and returns the tokens of a piece at once."""

    def eval(self, batch: pa.RecordBatch):
        for piece in text_pieces(batch, 1):
            words = pc.split_pattern(piece.column(1), " ")
            parents = pc.list_parent_indices(words)
            yield pa.table({"id": pc.take(piece.column(0), parents).cast(pa.int64()),
                            "word": pc.list_flatten(words)})


def arrow_udtf_tokens(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row ``(id_col, word)`` per token through the Arrow UDTF, called on
    the table ``(id, text)`` (a table argument, no per-row Python)."""
    arg = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).asTable()
    return SplitWordsArrow(arg).withColumnRenamed("id", id_col)


# ---------------------------------------------- X6: Arrow batches in Python
def arrow_token_counts(df: DataFrame, id_col: str, text: str, out: str = "n_tokens") -> DataFrame:
    """Token counts per row computed on whole Arrow batches (``mapInArrow``):
    a vectorised split in pyarrow, no per-row Python."""

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in text_pieces(b, 1):
                lengths = pc.list_value_length(pc.split_pattern(piece.column(1), " ")).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column(0), lengths], names=[id_col, out])

    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, {out} bigint"
    return df.select(id_col, text).mapInArrow(count_batches, schema)


# ------------------------------------------------ X3: algebraic aggregates
@dataclass(frozen=True)
class Combiner:
    """``init`` maps a value to a partial, ``combine`` merges two partials,
    ``zero`` is the result over no rows."""
    init: Callable[[Any], Any]
    combine: Callable[[Any, Any], Any]
    zero: Any


#: Tasks whose partials are combined in one step.
COMBINED = 64

COUNT = Combiner(init=lambda v: 1, combine=operator.add, zero=0)
SUM = Combiner(init=lambda v: v, combine=operator.add, zero=0)
ONE = Combiner(init=lambda v: 1, combine=lambda a, b: 1, zero=1)


def combine_by_key(df: DataFrame, keys: Sequence[str], value: str, comb: Combiner,
                   out: str = "value", out_type: str = "bigint") -> DataFrame:
    """Keyed aggregate with a user combiner.

    Map side: each Arrow batch is grouped by key and folded into one partial
    per key (``mapInArrow``), so memory is bounded by a batch and a hot key
    leaves it as a single row.  Reduce side: the partials of a key (at most
    one per batch) are combined in ``groupBy().applyInArrow``.
    """
    keys = list(keys)
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{key_schema}, {out} {out_type}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            named = pa.table([*b.columns[:-1], b.columns[-1]], names=[*keys, "_tp_v"])
            lists = named.group_by(keys).aggregate([("_tp_v", "list")])
            partial = [reduce(comb.combine, map(comb.init, vs)) for vs in lists.column("_tp_v_list").to_pylist()]
            arrays = [lists.column(k).combine_chunks().cast(arrow.field(k).type) for k in keys]
            arrays.append(pa.array(partial, type=arrow.field(len(keys)).type))
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def final(table: pa.Table) -> pa.Table:
        parts = table.column(out).to_pylist()
        total = parts[0]
        for p in parts[1:]:
            total = comb.combine(total, p)
        cols = [table.column(k).slice(0, 1) for k in keys]
        cols.append(pa.array([total], type=arrow.field(len(keys)).type))
        return pa.Table.from_arrays(cols, schema=arrow)

    partials = df.select(*keys, value).mapInArrow(fold, schema)
    return partials.groupBy(*keys).applyInArrow(final, schema)


def combine_all(df: DataFrame, value: str, comb: Combiner, out: str = "value",
                out_type: str = "bigint") -> DataFrame:
    """Global aggregate with a user combiner: one row, ``comb.zero`` over no
    rows.  Each task folds its batches into one partial; the partials of
    ``COMBINED`` neighbouring tasks are combined together, then the few that
    remain and the zero -- the identity of ``combine``."""
    schema = f"_tp_g int, _tp_p {out_type}"
    arrow, out_arrow = (to_arrow_schema(StructType.fromDDL(s)) for s in (schema, f"{out} {out_type}"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, total = None, None
        for b in batches:
            if not b.num_rows:
                continue
            partial = reduce(comb.combine, map(comb.init, b.column(1).to_pylist()))
            total = partial if group is None else comb.combine(total, partial)
            group = b.column(0)[0].as_py()
        if group is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip((group, total), arrow, strict=True)], schema=arrow)

    def step(table: pa.Table) -> pa.Table:
        total = reduce(comb.combine, table.column("_tp_p").to_pylist())
        return pa.Table.from_arrays([pa.array([x], type=f.type) for x, f in zip((0, total), arrow, strict=True)], schema=arrow)

    def final(table: pa.Table) -> pa.Table:
        total = reduce(comb.combine, table.column("_tp_p").to_pylist())
        return pa.Table.from_arrays([pa.array([total], type=out_arrow.field(0).type)], schema=out_arrow)

    tagged = df.select(F.expr(f"cast(spark_partition_id() div {COMBINED} as int)").alias("_tp_g"), value)
    zero = df.sparkSession.createDataFrame([(0, comb.zero)], schema)
    partials = tagged.mapInArrow(fold, schema).groupBy("_tp_g").applyInArrow(step, schema)
    return partials.unionByName(zero).groupBy("_tp_g").applyInArrow(final, f"{out} {out_type}")


# ------------------------------------------------- X4: per-batch aggregates
def batch_aggregate(df: DataFrame, batch_col: str, value: str, fn: Callable[[pd.Series], Any],
                    out: str = "value", out_type: str = "bigint") -> DataFrame:
    """``finishBatch``-style aggregate: a grouped-aggregate pandas UDF over
    each batch.  Grouped pandas aggregates get a whole group in one task, so
    use this only for groups with a size bound -- a batch holds at most
    ``size`` (or ``take`` x partitions) rows by construction."""
    agg = F.pandas_udf(fn, out_type)
    return df.groupBy(batch_col).agg(agg(F.col(value)).alias(out))


def count_rows(v: pd.Series) -> int:
    return int(len(v))
