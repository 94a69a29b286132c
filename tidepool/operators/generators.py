"""One row -> many rows (G1-G5, P6): tokenising and list expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import split_rule


def tokens(df: DataFrame, text: str, rule: str = "python", out: str = "word",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """G1-G3 + P6: one row per token of ``text`` under the given split rule,
    appended to the kept columns.  A null text yields no rows."""
    return df.select(*keep, F.explode(split_rule(text, rule)).alias(out))


def token_counts(df: DataFrame, id_col: str, text: str, rule: str = "python",
                 out: str = "n_tokens") -> DataFrame:
    """Tokens per row without materialising them: ``size`` of the split
    (null for a null text, whatever ``sizeOfNull`` says)."""
    n = F.when(F.col(text).isNull(), F.lit(None)).otherwise(F.size(split_rule(text, rule)))
    return df.select(id_col, n.cast("long").alias(out))


def expand_list(df: DataFrame, list_col: str, out: str, position: str | None = None,
                keep_empty: bool = False) -> DataFrame:
    """One row per element of an array column; a null or empty list gives
    no rows.  ``keep_empty`` keeps such a row once, with a null element
    (P14: when the request row must survive a lookup miss)."""
    others = [c for c in df.columns if c != list_col]
    if position:
        gen = F.posexplode_outer(list_col) if keep_empty else F.posexplode(list_col)
        return df.select(*others, gen.alias(position, out))
    gen = F.explode_outer(list_col) if keep_empty else F.explode(list_col)
    return df.select(*others, gen.alias(out))
