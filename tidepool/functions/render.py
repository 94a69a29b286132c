"""Rendering of ranked items and rankings as text (P10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def render_item(obj: str | Column, count: str | Column, fields: str | Column | None = None) -> Column:
    """``[obj|count|f1|f2...]``.  Nulls print as ``null`` (``concat_ws`` would
    silently drop them)."""
    parts = [F.coalesce(_c(obj).cast("string"), F.lit("null")),
             F.coalesce(_c(count).cast("string"), F.lit("null"))]
    if fields is not None:
        f = F.transform(_c(fields), lambda x: F.coalesce(x.cast("string"), F.lit("null")))
        parts.append(F.coalesce(f, F.array().cast("array<string>")))
    return F.concat(F.lit("["), F.concat_ws("|", *parts), F.lit("]"))


def render_list(items: str | Column) -> Column:
    """``[item1, item2, ...]`` for an (ordered) array of rendered items."""
    return F.concat(F.lit("["), F.array_join(_c(items), ", "), F.lit("]"))
