"""Exact dedup by a heavy-hitter split (DataFrame functions only).

A Misra-Gries summary (Spark's ``approx_top_k``, a frequent-items sketch whose
partial summaries are merged map-side) names at most ``HEAVY`` digests that may
be frequent.  One pass verifies them: exact group size and largest ``doc_id``
per candidate.  The verified winners, at most ``HEAVY`` rows, are broadcast, so
rows of a hot group are decided where they are read and never shuffled.  The
remaining digests go through an ordinary shuffle on the digest.

Defined results
* null text counts as the empty text, and empty texts are equal to each other;
* the row with the largest ``doc_id`` of a group stays; null ids sort lowest
  (``keep_id`` is null only if every id of the group is null);
* rows that repeat both ``doc_id`` and text are copies like any other: exactly
  one row of a group has ``kept``.  Where the largest id of a frequent digest
  occurs more than once (or all its ids are null), the rows with that id alone
  are shuffled: first in ``SALTS`` parts, of which each names one row, then
  the named rows among themselves;
* an empty table gives an empty result; extra columns are carried along, and
  helper columns have names that no table uses (prefix ``__xd_``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most digests that are broadcast as winners (documented bound: 1,000 rows of about 100 bytes).
HEAVY = 1_000
#: Counters of the Misra-Gries summary; a digest above about 1/7,500 of the rows is always among them.
COUNTERS = 10_000
#: Parts over which the tied rows of one frequent digest are dealt.
SALTS = 256

_DIGEST, _KEEP, _SIZE, _TOPS, _SALT, _RANK = (f"__xd_{c}" for c in ("digest", "keep", "size", "tops", "salt", "rank"))


def _heavy_winners(digests: DataFrame, id_col: str) -> DataFrame:
    """Verified winners: (digest, keep id, group size, rows with that id), at most HEAVY rows."""
    found = (digests.agg(F.expr(f"approx_top_k({_DIGEST}, {HEAVY}, {COUNTERS})").alias("__xd_items"))
             .select(F.explode("__xd_items").alias("__xd_item"))
             .where("__xd_item.count > 1")
             .select(F.col("__xd_item.item").alias(_DIGEST)))
    # (id, rows with it) ordered by id: the largest id and how often it occurs, in one aggregate
    per_id = (digests.join(F.broadcast(found), _DIGEST)
              .groupBy(_DIGEST, id_col).agg(F.count(F.lit(1)).alias("__xd_n")))
    return (per_id.groupBy(_DIGEST)
            .agg(F.max(id_col).alias(_KEEP), F.sum("__xd_n").alias(_SIZE),
                 F.max(F.struct(F.col(id_col).alias("i"), F.col("__xd_n").alias("n")))["n"].alias(_TOPS))  # null ids sort lowest
            .where(F.col(_SIZE) > 1))


def _one_of_tied(tied: DataFrame) -> DataFrame:
    """``kept`` is true for one row of each digest, whatever the number of its rows."""
    dealt = tied.withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    named = dealt.withColumn(_RANK, F.row_number().over(Window.partitionBy(_DIGEST, _SALT).orderBy(F.lit(0))))
    # named rows meet in a group of at most SALTS rows; the others stay in their parts
    among = Window.partitionBy(_DIGEST, F.when(F.col(_RANK) == 1, -1).otherwise(F.col(_SALT))).orderBy(_SALT, _RANK)
    return named.withColumn("kept", (F.row_number().over(among) == 1) & (F.col(_RANK) == 1))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` added (replacing columns of these names)."""
    out = ["keep_id", "group_size", "kept", "text_sha256"]
    carried = [c for c in docs.columns if c not in out]
    d = docs.select(*[F.col(f"`{c}`") for c in carried],
                    F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias(_DIGEST))
    winners = F.broadcast(_heavy_winners(d.select(_DIGEST, id_col), id_col))

    heavy = d.join(winners, _DIGEST).withColumn("kept", F.col(id_col).eqNullSafe(F.col(_KEEP)))
    may_tie = F.col("kept") & (F.col(_TOPS) > 1)
    rest = d.join(winners.select(_DIGEST), _DIGEST, "left_anti")
    group = Window.partitionBy(_DIGEST)
    ranked = group.orderBy(F.col(id_col).desc_nulls_last())
    light = (rest.withColumn("__xd_rank", F.row_number().over(ranked))
             .withColumn(_KEEP, F.max(id_col).over(group))
             .withColumn(_SIZE, F.count(F.lit(1)).over(group))
             .withColumn("kept", F.col("__xd_rank") == 1))
    cols = [*[F.col(f"`{c}`") for c in carried], F.col(_KEEP).alias("keep_id"),
            F.col(_SIZE).alias("group_size"), F.col("kept"), F.col(_DIGEST).alias("text_sha256")]
    return (heavy.where(~may_tie).select(*cols)
            .unionByName(_one_of_tied(heavy.where(may_tie)).select(*cols))
            .unionByName(light.select(*cols)))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` with its own columns."""
    own = {c: f"__xd_own_{c}" for c in ("keep_id", "group_size", "kept", "text_sha256") if c in docs.columns}
    marked = exact_dedup(docs.withColumnsRenamed(own), id_col, text_col).where("kept")
    return marked.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])
