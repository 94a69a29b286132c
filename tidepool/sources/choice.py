"""Random-choice sentence sources (S1-S4), replayable.

The reference draws a sentence uniformly at random every period.  Here the
draw is a seeded arithmetic mix of a row id, so a replay (or a retried task)
draws the same sentence, and the same arithmetic can be written in SQL.
Batch form: one draw per row of a driving table.  Streaming form: the
``rate`` source's ``value`` column is the row id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's vocabularies.
RANDOM_SENTENCES = (
    "the cow jumped over the moon",
    "an apple a day keeps the doctor away",
    "four score and seven years ago",
    "snow white and the seven dwarfs",
    "i am at two with nature",
)
CLOJURE_SENTENCES = (
    "a little brown dog",
    "the man petted the dog",
    "four score and seven years ago",
    "an apple a day keeps the doctor away",
)
PARAMETERIZED_EXAMPLE = (
    "the cat jumped over the door",
    "greetings from a faraway land",
)

# Mixing constants of a classic 31-bit linear congruential generator.
_MULT = 1103515245
_INC = 12345
_MOD = 2147483648  # 2**31
_SHIFT = 65536     # drop the weak low bits


def pick_index(row_id: str | Column, n: int, seed: int = 0) -> Column:
    """0-based index in ``[0, n)`` from a non-negative integral row id.

    ``((id + seed) mod 2^31) * a + c`` stays below 2^62, so the arithmetic
    never overflows 64 bits for any id.
    """
    if n < 1:
        raise ValueError("the vocabulary must not be empty")
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    x = F.pmod(rid.cast("long") + F.lit(seed), F.lit(_MOD))
    mixed = F.pmod(x * F.lit(_MULT) + F.lit(_INC), F.lit(_MOD))
    return F.pmod(F.floor(mixed / F.lit(_SHIFT)), F.lit(n)).cast("int")


def choice(row_id: str | Column, vocab: Sequence[str], seed: int = 0) -> Column:
    """The chosen vocabulary entry for each row."""
    arr = F.array(*[F.lit(s) for s in vocab])
    return F.element_at(arr, pick_index(row_id, len(vocab), seed) + F.lit(1))


def choice_source(df: DataFrame, row_id: str, vocab: Sequence[str] = RANDOM_SENTENCES,
                  seed: int = 0, out: str = "sentence") -> DataFrame:
    """S1/S2/S3 in batch form: one draw per row of ``df`` (keeps ``row_id``)."""
    return df.select(row_id, choice(row_id, vocab, seed).alias(out))


def choice_stream(spark: SparkSession, vocab: Sequence[str] = RANDOM_SENTENCES,
                  rows_per_second: int = 10, seed: int = 0, out: str = "sentence",
                  num_partitions: int | None = None) -> DataFrame:
    """S1/S2/S3 as an unbounded stream: the reference's 100 ms period is
    ``rows_per_second=10`` (500 ms is 2)."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if num_partitions:
        reader = reader.option("numPartitions", num_partitions)
    return reader.load().select("timestamp", "value", choice("value", vocab, seed).alias(out))
