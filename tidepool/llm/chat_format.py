"""Multi-party perspective rotation of conversations (DataFrame functions only).

For every participant of a dialogue the dialogue is rendered once with that
speaker as the assistant and everyone else as a named user; the loss mask lists
the character spans of the assistant's words (with the closing mark, so that a
model learns to stop).  System messages keep their role in every rendering.

Every participant of a conversation gets the whole dialogue, in parts of
``TURNS_PER_PART`` messages by their rank; the parts of one perspective, joined
in order, are the dialogue, and mask offsets run over the whole of it.  Ranks
come from one sort over all conversations: a task counts its own messages, and
the conversations that border between two tasks (fewer than there are tasks)
get the sum of the earlier tasks' counts.  So a conversation that holds a third
of all rows, or a turn number that does, is spread over many tasks.  Where a
part starts follows from sums of lengths, before any text is rendered.

Defined results: null text is empty, a null role is the speaker ``unknown``, a
null turn sorts before all others; messages of one turn number
order by (role, text); rows that repeat (conv_id, turn, role, text) are one
message; a null conv_id is a conversation of its own; a conversation of system
messages alone has no participant and gives no row; a part in which a
participant is silent has an empty mask; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.scratch import saved

TURNS_PER_PART = 64
END = "<|end|>\n"
_OWN, _SYSTEM = "<|assistant|>\n", "<|system|>\n"


def _in_parts(conversations: DataFrame, turns_per_part: int) -> DataFrame:
    """(conv, part, rank, role, text) of the distinct messages; ``conv`` is a
    struct, so that a null conv_id equals itself."""
    messages = conversations.select(F.struct("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
                                    F.coalesce("text", F.lit("")).alias("text")).distinct()
    order = ["conv", "turn", "role", "text"]
    # the place (partition and number in it) is written, so every later reading has the same one
    placed = saved(messages.repartitionByRange(*order).sortWithinPartitions(*order)
                   .select("conv", "role", "text", F.monotonically_increasing_id().alias("place")))
    placed = placed.withColumn("task", F.shiftright("place", 33))
    counts = placed.groupBy("conv", "task").agg(F.count(F.lit(1)).alias("n"))
    # a conversation in k tasks takes all of at least k - 2 of them: at most two rows per task in all
    earlier = (counts.withColumn("before", F.sum("n").over(Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
               .where("before is not null").select("conv", "task", "before"))
    number = F.row_number().over(Window.partitionBy("conv", "task").orderBy("place")) - 1
    return (placed.withColumn("number", number).join(F.broadcast(earlier), ["conv", "task"], "left")
            .withColumn("rank", F.col("number") + F.coalesce("before", F.lit(0)))
            .select("conv", F.floor(F.col("rank") / F.lit(turns_per_part)).cast("long").alias("part"), "rank", "role", "text"))


def _starts(messages: DataFrame) -> DataFrame:
    """(conv, part, perspective, start): the dialogue's length before each part, for every participant."""
    as_other = F.when(F.col("role") == "system", len(_SYSTEM)).otherwise(F.length("role") + len("<|user name=|>\n"))
    by_role = (messages.groupBy("conv", "part", "role")
               .agg(F.sum(as_other + F.length("text") + len(END)).alias("chars"), F.sum(F.lit(len(_OWN)) - as_other).alias("more")))
    parts = by_role.groupBy("conv", "part").agg(F.sum("chars").alias("chars"))
    speakers = by_role.where("role != 'system'").select("conv", F.col("role").alias("perspective")).distinct()
    own = by_role.select("conv", "part", F.col("role").alias("perspective"), "more")
    before = Window.partitionBy("conv", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (parts.join(speakers, "conv").join(own, ["conv", "part", "perspective"], "left")
            .select("conv", "part", "perspective",
                    F.coalesce(F.sum(F.col("chars") + F.coalesce("more", F.lit(0))).over(before), F.lit(0)).alias("start")))


def rotate(conversations: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """(conv_id, part, perspective, n_turns, start, n_chars, text, mask): ``text``
    is the part of the dialogue that starts at code point ``start`` of it;
    ``mask`` is ``start:end`` of each assistant span (code points of the whole
    dialogue, end exclusive), comma-joined in order."""
    messages = _in_parts(conversations, turns_per_part)
    parts = (messages.groupBy("conv", "part")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "role", "text"))).alias("ms")))
    headed = parts.join(_starts(messages), ["conv", "part"]).withColumn("ms", F.expr(
        f"transform(ms, m -> struct(m.role = perspective as own, "
        f"case when m.role = perspective then '{_OWN}' when m.role = 'system' then '{_SYSTEM}' "
        "else concat('<|user name=', m.role, '|>\n') end as head, "
        f"concat(m.text, '{END}') as body))"))
    # running offset: spans collected while folding over the messages of the part
    folded = headed.withColumn("fold", F.expr(
        "aggregate(ms, struct(start as at, cast(array() as array<string>) as spans), (a, m) -> struct("
        "a.at + length(m.head) + length(m.body) as at, "
        "if(m.own, array_append(a.spans, concat(cast(a.at + length(m.head) as string), ':', "
        "cast(a.at + length(m.head) + length(m.body) as string))), a.spans) as spans))"))
    return folded.select(
        F.col("conv.conv_id").alias("conv_id"), "part", "perspective", F.size("ms").cast("long").alias("n_turns"),
        "start", (F.col("fold.at") - F.col("start")).alias("n_chars"),
        F.expr("array_join(transform(ms, m -> concat(m.head, m.body)), '')").alias("text"),
        F.array_join("fold.spans", ",").alias("mask"))
