"""Bounded training samples and the fold rule of the labelled tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Resolution of the hash that thins ids.
STEPS = 1 << 30


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5, is 0; a null id counts as the empty text (held out)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _any(conditions: list[Column]) -> Column:
    """Their disjunction, as a balanced tree: its depth grows with the logarithm of their number."""
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:]) if half else conditions[0]


def bounded_ids(labelled: DataFrame, label: str, wanted: int, id_col: str = "doc_id") -> DataFrame:
    """(id, label) of about ``wanted`` rows of every label, never more than
    twice that, outside the held-out fold.  Labels are counted
    over all rows, then ids are thinned by a hash to what is wanted, so what is
    shuffled does not grow with the table; no text is read."""
    rows = labelled.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(id_col, label)
    counts = rows.groupBy(label).count().collect()
    if not counts:
        return rows.limit(0)
    place = F.pmod(F.xxhash64(F.col(id_col)), F.lit(STEPS))
    thin = _any([(F.col(label) == r[label]) & (place < min(STEPS, 1 + STEPS * wanted // r["count"])) for r in counts])
    order = Window.partitionBy(label).orderBy(place, F.col(id_col))
    return (rows.where(thin).distinct().withColumn("__s_rank", F.row_number().over(order))
            .where(F.col("__s_rank") <= 2 * wanted).drop("__s_rank"))


def bounded_sample(texts: DataFrame, labelled: DataFrame, label: str, per_label: int, max_chars: int, text: str = "text",
                   id_col: str = "doc_id", spare: int = 6, piece_from: Column | None = None) -> list:
    """At most ``per_label`` (text, label) rows of each label, of texts of 1 to
    ``max_chars`` code points, by a hash of the id: the documented bound of
    every model fitted here.  With ``piece_from`` a label with fewer such texts
    is filled up with pieces of its longer ones, ``max_chars`` code points from
    that place on.  The ids, at most 2 * spare * per_label of a label, are
    broadcast to the texts."""
    ids = bounded_ids(labelled, label, spare * per_label, id_col)
    ids = ids.select(F.col(id_col).alias("__s_id"), F.col(label).alias("__s_label"))
    short = F.length(text).between(1, max_chars)
    if piece_from is None:
        fit = texts.select(id_col, text).where(short).withColumn("__s_long", F.lit(False))
    else:
        piece = F.when(short, F.col(text)).otherwise(F.substring(text, piece_from, F.lit(max_chars)))
        fit = texts.where(F.length(text) > 0).select(id_col, piece.alias(text), (~short).alias("__s_long"))
    fit = fit.join(F.broadcast(ids), F.col(id_col) == F.col("__s_id"))
    order = Window.partitionBy("__s_label").orderBy("__s_long", F.pmod(F.xxhash64("__s_id"), F.lit(STEPS)), "__s_id", F.xxhash64(text))
    rows = fit.withColumn("__s_rank", F.row_number().over(order)).where(F.col("__s_rank") <= per_label).collect()
    return [(r[text], r["__s_label"]) for r in sorted(rows, key=lambda r: (r["__s_label"], r["__s_rank"]))]
