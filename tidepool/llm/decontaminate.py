"""Benchmark decontamination by winnowing (DataFrame functions only).

Words are maximal runs of ASCII letters, digits and non-ASCII characters, with
A-Z lower-cased.  A window is ``WINDOW`` consecutive words of an item; an item
of fewer words is one window as a whole.

1. *Winnow.*  Hash every ``K``-gram of words and keep, per sliding window of
   ``WINDOW - K + 1`` hashes, the smallest (``fingerprints``).  Any span of
   ``WINDOW`` shared words covers one whole sliding window in document and item
   alike, so both keep the same smallest hash of it: every shared window has a
   common fingerprint.  Items too short for a ``K``-gram or a sliding window
   are fingerprinted by their whole hash, and documents are hashed at just the
   lengths of such items.
2. *Join* document and item fingerprints on the hash.  Catalyst broadcasts the
   item side when its size allows and shuffles otherwise.
3. *Extend.*  A hit at word ``p`` can lie only in the windows that start at
   ``p - (WINDOW - K) .. p``.  Those windows of the hit documents are compared
   word for word (join on the words themselves) with the windows of the items,
   so hash collisions never reach the result.

Defined results: null and wordless texts have no words and no hits; an item
without words has no window; repeated items count under each distinct id, null
ids are not listed (their words still count as hit); rows that repeat both id
and text get equal results; empty tables give empty results or no hits; extra
columns of both tables are ignored by ``contamination`` and kept by
``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Words of a hashed gram.
K = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Gaps between words in a text that may still hold capitals.
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _cut(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAPS), "")


def words(text: Column) -> Column:
    """Array of words, empty for null."""
    return _cut(F.translate(text, _UPPER, _LOWER))


def folded_words(text: Column) -> Column:
    """Words with every letter lower-cased: equal words stay equal, so it serves
    for fingerprints of whole tables, where ``translate`` would cost most of the time.
    The capital sigma, the one letter that is lower-cased by what surrounds it, is replaced first."""
    return _cut(F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3"))))


def _grams(ws: str, k: int) -> str:
    """SQL: of all k-grams of the word array ``ws``, one long each: 32 bits of
    the hash above 32 bits of the position, so that longs order by hash, then
    position, and arrays of them stay primitive."""
    return (f"if(size({ws}) < {k}, cast(array() as array<bigint>), "
            f"transform(sequence(0, size({ws}) - {k}), i -> (xxhash64(slice({ws}, i + 1, {k})) & -4294967296L) | i))")


def _winnowed(packed: str, w: int) -> str:
    """SQL: distinct smallest longs of each run of ``w`` longs."""
    return (f"if(size({packed}) < {w}, cast(array() as array<bigint>), "
            f"array_distinct(transform(sequence(0, size({packed}) - {w}), i -> array_min(slice({packed}, i + 1, {w})))))")


def _hash_of(packed: str) -> Column:
    return F.shiftright(packed, 32).cast("int").alias("h")


def _place_of(packed: str) -> Column:
    return F.col(packed).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("p")


def _doc_key() -> list[Column]:
    """Rows equal in id and text are one document for the joins."""
    return [F.col("doc_id"), F.xxhash64(F.col("text")).alias("text_hash"), F.length("text").alias("text_len")]


def _hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Occurring windows: (doc_id, text_hash, text_len, start, length, item_id)."""
    run = window - k + 1
    items = benchmark.select("item_id", words(F.col("text")).alias("ws")).where("size(ws) > 0")
    long_items = items.where(f"size(ws) >= {window}")
    short_items = items.where(f"size(ws) < {window}").withColumn("len", F.size("ws"))

    folded = benchmark.select(folded_words(F.col("text")).alias("ws"))
    item_prints = (folded.where(f"size(ws) >= {window}").withColumn("g", F.expr(_grams("ws", k)))
                   .select(F.explode(F.expr(_winnowed("g", run))).alias("f")).select(_hash_of("f"), F.lit(window).alias("len")))
    short_prints = folded.where(f"size(ws) between 1 and {window - 1}").select(F.xxhash64("ws").alias("f"), F.size("ws").alias("len")).select(_hash_of("f"), "len")
    prints = item_prints.unionByName(short_prints).distinct()
    lengths = [r[0] for r in short_items.select("len").distinct().limit(window).collect()]  # fewer than WINDOW values

    keyed = docs.where("text is not null").select(*_doc_key(), "text")
    hashed = keyed.select("doc_id", "text_hash", "text_len", folded_words(F.col("text")).alias("ws"))
    hashed = hashed.withColumn("g", F.expr(_grams("ws", k)))
    found = hashed.select("doc_id", "text_hash", "text_len",
                          F.explode(F.expr(_winnowed("g", run))).alias("f"))
    found = found.select("doc_id", "text_hash", "text_len", _hash_of("f"), _place_of("f"), F.lit(window).alias("len"))
    for n in sorted(lengths):
        whole = hashed.select("doc_id", "text_hash", "text_len", F.explode(F.expr(_grams("ws", n))).alias("f"))
        found = found.unionByName(whole.select("doc_id", "text_hash", "text_len", _hash_of("f"), _place_of("f"),
                                               F.lit(n).alias("len")))
    hits = found.join(prints, ["h", "len"], "left_semi")

    # candidate windows around the hits, one row per document
    spots = (hits.groupBy("doc_id", "text_hash", "text_len")
             .agg(F.collect_set(F.struct("len", "p")).alias("spots")))
    # length and start of each window as one long, for the same reason as above
    starts = (f"array_distinct(flatten(transform(spots, x -> if(x.len < {window}, array(shiftleft(bigint(x.len), 32) | x.p), "
              f"transform(sequence(greatest(x.p - {window - k}, 0), x.p), s -> shiftleft(bigint({window}), 32) | s)))))")
    near = (keyed.alias("d").join(spots.alias("k"),
                                  F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                                  & (F.col("d.text_hash") == F.col("k.text_hash"))
                                  & (F.col("d.text_len") == F.col("k.text_len")))
            .select("d.doc_id", "d.text_hash", "d.text_len", words(F.col("d.text")).alias("ws"),
                    F.expr(starts).alias("at"))
            .select("doc_id", "text_hash", "text_len", F.explode(F.expr(
                "transform(filter(transform(at, a -> struct(int(shiftright(a, 32)) as n, int(a & 4294967295L) as s)), "
                "a -> a.s + a.n <= size(ws)), a -> "
                "struct(a.n as n, a.s as s, array_join(slice(ws, a.s + 1, a.n), ' ') as w))")).alias("c"))
            .select("doc_id", "text_hash", "text_len", "c.n", "c.s", "c.w").distinct())
    spans = (long_items.select("item_id", F.lit(window).alias("n"), F.explode(F.expr(
        f"transform(sequence(0, size(ws) - {window}), s -> array_join(slice(ws, s + 1, {window}), ' '))")).alias("w"))
        .unionByName(short_items.select("item_id", F.col("len").alias("n"), F.array_join("ws", " ").alias("w")))
        .distinct())
    return (near.join(spans, ["n", "w"])
            .select("doc_id", "text_hash", "text_len", F.col("s").alias("start"), F.col("n").alias("length"), "item_id"))


def _per_document(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Of hit documents: n_hit, n_items, items_sha256."""
    hits = _hits(docs, benchmark)
    items = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    return (hits.groupBy("doc_id", "text_hash", "text_len")
            .agg(F.collect_set(F.struct("start", "length")).alias("spans"), items.alias("items"))
            .select("doc_id", "text_hash", "text_len",
                    F.expr("cast(size(array_distinct(flatten(transform(spans, x -> "
                           "sequence(x.start, x.start + x.length - 1))))) as bigint)").alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256")))


def _same(a: str, b: str) -> Column:
    """Null-safe equality of two documents' keys (text hash and length are null together)."""
    return (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
            & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))
            & (F.col(f"{a}.text_len") == F.col(f"{b}.text_len")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated."""
    per_doc = _per_document(docs, benchmark)
    base = docs.select(*_doc_key(), F.size(_cut(F.col("text"))).cast("long").alias("n_words"))
    none = F.sha2(F.lit(""), 256)
    return (base.alias("b").join(per_doc.alias("h"), _same("b", "h"), "left")
            .select(F.col("b.doc_id").alias("doc_id"), F.col("b.n_words").alias("n_words"),
                    F.coalesce(F.col("h.n_hit"), F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce(F.col("h.n_items"), F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce(F.col("h.items_sha256"), none).alias("items_sha256"),
                    F.coalesce(F.col("h.n_hit") > 0, F.lit(False)).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no window of an item."""
    hit = _hits(docs, benchmark).select(F.col("doc_id").alias("__dc_id"), F.col("text_hash").alias("__dc_hash"),
                                        F.col("text_len").alias("__dc_len")).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("__dc_id")) & (F.xxhash64(F.col("text")) == F.col("__dc_hash"))
                     & (F.length("text") == F.col("__dc_len")), "left_anti")
