"""Text columns: suffix projections and the three sentence-split rules.

All of these are built-in Spark expressions (JVM side, whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (the reference's suffixes).
EXCLAIM = "!!!"
QUESTION = "???"
REQUEST_EXCLAIM = "!"

# Ruby's awk-style split on " " treats these six ASCII characters as
# whitespace: space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE_CLASS = "[ \t\n\x0b\f\r]+"

SPLIT_RULES = ("python", "java", "whitespace")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def suffix(col: str | Column, text: str) -> Column:
    """``col || text``."""
    return F.concat(_c(col), F.lit(text))


def append_suffix(df: DataFrame, col: str, text: str, out: str | None = None) -> DataFrame:
    """DataFrame form of ``suffix``: replaces ``col`` (or adds ``out``).
    Applying it twice is two chained projections, which Catalyst collapses."""
    return df.withColumn(out or col, suffix(col, text))


def split_python(col: str | Column) -> Column:
    """``str.split(" ")``: every space separates, all empty tokens are kept."""
    return F.split(_c(col), " ", -1)


def split_java(col: str | Column) -> Column:
    """``String.split(" ")``: like the Python rule, but trailing empty tokens
    are dropped; ``""`` gives ``[""]`` and a string of spaces gives ``[]``.
    ``rtrim`` strips spaces only (not newlines), as the Java rule requires."""
    c = _c(col)
    trimmed = F.rtrim(c)
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(trimmed == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))


def split_whitespace(col: str | Column) -> Column:
    """Ruby ``split(" ")``: runs of whitespace separate, no empty tokens."""
    return F.filter(F.split(_c(col), WHITESPACE_CLASS, -1), lambda t: t != F.lit(""))


def split_rule(col: str | Column, rule: str = "python") -> Column:
    if rule == "python":
        return split_python(col)
    if rule == "java":
        return split_java(col)
    if rule == "whitespace":
        return split_whitespace(col)
    raise ValueError(f"unknown split rule {rule!r}; expected one of {SPLIT_RULES}")
