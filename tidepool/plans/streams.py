"""The reference's long-running pipelines as streaming jobs.

Each ``*_job`` starts a Structured Streaming query (checkpointed in the
shared folder) and returns it.  ``available_now=True`` processes what is
there and stops (tests, catch-up runs); otherwise the query keeps running on
``every`` (the reference's emit period).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions.text import split_rule, suffix
from tidepool.operators import windows as W
from tidepool.operators.counts import word_count
from tidepool.operators.distribution import merge_streams
from tidepool.operators.generators import tokens
from tidepool.operators.reach import lookup_sum, reach
from tidepool.streaming.joins import stream_single_join
from tidepool.streaming.runner import run_foreach_batch
from tidepool.streaming.stateful import ranking_each_batch, running_count_stream
from tidepool.streaming.versioned import (
    BatchOutput, VersionedStore, bucket_counter, global_counter, keyed_counter,
)


def _start(df: DataFrame, name: str, body: Callable[[DataFrame, int], None], available_now: bool, every: str,
           checkpoint: str | None = None) -> StreamingQuery:
    """Run ``body`` per micro-batch, once over what is there or on the period ``every``."""
    return run_foreach_batch(df, name, body, checkpoint=checkpoint, processing_time=None if available_now else every)


def _append_to(output: BatchOutput) -> Callable[[DataFrame, int], None]:
    """The sink of row pipelines: each micro-batch is written under its id,
    overwritten by a replay, so rows are durable and never doubled."""
    return lambda batch, batch_id: output.write(batch, batch_id)


def word_tokens_stream(sentences: DataFrame, text: str, order: Sequence[str], rule: str) -> DataFrame:
    """Sentences -> one row per word with its position, so that words of one
    sentence have a total order too."""
    return sentences.select(*order, F.posexplode(split_rule(text, rule)).alias("pos", "word"))


def running_word_count(sentences: DataFrame, text: str = "sentence", order: Sequence[str] = ("seq",),
                       rule: str = "python") -> DataFrame:
    """Q3 / Q4: split every sentence and emit ``(word, count so far)`` per word
    occurrence (streaming DataFrame, append mode)."""
    toks = word_tokens_stream(sentences, text, order, rule)
    return running_count_stream(toks, "word", [*order, "pos"])


def running_word_count_job(sentences: DataFrame | Sequence[DataFrame], output: BatchOutput, name: str,
                           text: str = "sentence", order: Sequence[str] = ("seq",), rule: str = "python",
                           available_now: bool = True, every: str = "1 second",
                           checkpoint: str | None = None) -> StreamingQuery:
    """Q3, and Q4 over several running sources: sentence streams are merged
    (their columns by position) and counted together, rows to ``output``."""
    if not isinstance(sentences, DataFrame):
        sentences = merge_streams(sentences, [*order, text])
    return _start(running_word_count(sentences, text, order, rule), name, _append_to(output), available_now, every,
                  checkpoint)


def rolling_top_words_job(events: DataFrame, output: BatchOutput, name: str, obj: str, ts: str,
                          window_seconds: int, emit_seconds: int, top_n: int, stream_start: Column,
                          watermark: str, available_now: bool = True,
                          checkpoint: str | None = None) -> StreamingQuery:
    """Q5: rolling counts per object (slot pre-aggregated), then the top N of
    every window as it is finalised by the watermark, written per batch id."""
    counts = W.rolling_count(events, obj, ts, window_seconds, emit_seconds, stream_start=stream_start,
                             watermark=watermark)
    body = ranking_each_batch(output, ["window_start", "window_end"], "obj", "count", top_n)
    return _start(counts, name, body, available_now, f"{emit_seconds} seconds", checkpoint)


def single_join_job(left: DataFrame, right: DataFrame, output: BatchOutput, name: str, keys: Sequence[str], left_ts: str,
                    right_ts: str, timeout_seconds: int, watermark: str, out_fields: Sequence[str],
                    available_now: bool = True, every: str = "1 second",
                    checkpoint: str | None = None) -> StreamingQuery:
    """Q6: join the sides of each key within the time-out; write ``out_fields`` to ``output``."""
    joined = stream_single_join(left, right, keys, left_ts, right_ts, timeout_seconds, watermark)
    return _start(joined.select(*out_fields), name, _append_to(output), available_now, every, checkpoint)


def persistent_word_count_job(sentences: DataFrame, store: VersionedStore, name: str,
                              text: str = "sentence", rule: str = "java", available_now: bool = True,
                              every: str = "1 second", checkpoint: str | None = None) -> StreamingQuery:
    """Q12: word counts kept as versioned state (one version per micro-batch)."""
    words = tokens(sentences, text, rule)
    return _start(words, name, keyed_counter(store, "word"), available_now, every, checkpoint)


def words_query(requests: DataFrame, store: VersionedStore, rule: str = "java") -> DataFrame:
    """Q13: for each request ``(request_id, args)``, the sum of the current
    counts of its words (missing words ignored, 0 when none is known)."""
    counts = store.latest().withColumnRenamed("key", "word")
    words = tokens(requests, "args", rule, keep=("request_id",))
    return lookup_sum(words, counts, requests=requests)[1]


def words_query_job(requests: DataFrame, store: VersionedStore, output: BatchOutput, name: str, rule: str = "java",
                    available_now: bool = True, every: str = "1 second",
                    checkpoint: str | None = None) -> StreamingQuery:
    """Q13 with requests arriving as a stream: each micro-batch of
    ``(request_id, args)`` is answered from the newest counts."""

    def body(batch: DataFrame, batch_id: int) -> None:
        output.write(words_query(batch, store, rule), batch_id)

    return _start(requests, name, body, available_now, every, checkpoint)


def transactional_global_count_job(stream: DataFrame, store: VersionedStore, output: BatchOutput, name: str,
                                   available_now: bool = True, every: str = "1 second",
                                   checkpoint: str | None = None) -> StreamingQuery:
    """Q14 / Q15: rows per micro-batch and their running total, replay-safe."""
    return _start(stream, name, global_counter(store, output), available_now, every, checkpoint)


def transactional_words_job(stream: DataFrame, counts: VersionedStore, buckets: VersionedStore,
                            changelog: BatchOutput, bucket_output: BatchOutput, name: str, key: str = "word",
                            available_now: bool = True, every: str = "1 second",
                            checkpoint: str | None = None) -> StreamingQuery:
    """Q16: keyed counts with their changelog, and the count-of-counts
    histogram moved by +/-1 deltas, replay-safe."""
    body = bucket_counter(counts, buckets, key, changelog, bucket_output)
    return _start(stream, name, body, available_now, every, checkpoint)


def reach_requests_job(requests: DataFrame, hop1: DataFrame, hop2: DataFrame, output: BatchOutput, name: str,
                       method: str = "distinct", available_now: bool = True, every: str = "1 second",
                       checkpoint: str | None = None) -> StreamingQuery:
    """Q9 / Q10 / Q11 with requests arriving as a stream: every micro-batch of
    ``(request_id, url)`` rows is answered against the static edge tables in
    one job, one ``(request_id, reach)`` row per request, written per batch id
    (``method="group_one"`` is the declarative group -> One -> Sum form)."""

    def body(batch: DataFrame, batch_id: int) -> None:
        output.write(reach(batch, hop1, hop2, method=method), batch_id)

    return _start(requests, name, body, available_now, every, checkpoint)


def suffix_job(words: DataFrame, output: BatchOutput, name: str, col: str = "word", text: str = "!!!", times: int = 2,
               available_now: bool = True, every: str = "1 second",
               checkpoint: str | None = None) -> StreamingQuery:
    """Q1 / Q2: the suffix projection applied ``times`` times to every row
    (chained projections, collapsed by Catalyst)."""
    out = words
    for _ in range(times):
        out = out.withColumn(col, suffix(col, text))
    return _start(out, name, _append_to(output), available_now, every, checkpoint)


def exclaim_requests_job(requests: DataFrame, output: BatchOutput, name: str, text: str = "!",
                         result_first: bool = False, available_now: bool = True, every: str = "1 second",
                         checkpoint: str | None = None) -> StreamingQuery:
    """Q7 / Q8: answer every request ``(request_id, args)`` with ``args + text``;
    ``result_first`` gives the ``(result, return_info)`` layout."""
    res = suffix("args", text).alias("result")
    cols = [res, F.col("request_id").alias("return_info")] if result_first else [F.col("request_id"), res]
    return _start(requests.select(*cols), name, _append_to(output), available_now, every, checkpoint)


def word_count_batch(sentences: DataFrame, text: str = "sentence", rule: str = "java") -> DataFrame:
    """Q12 over a bounded input: the same counts in one batch job."""
    return word_count(tokens(sentences, text, rule))
