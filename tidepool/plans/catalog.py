"""Named queries on the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
*whole* tables it reads.  Conventions (see SURVEY §7.3):

* events as a word stream: word := ``event_type``, actor := ``user_id``,
  time := ``ts`` (``timestamp_ntz``; slot arithmetic does not depend on
  the session time zone);
* counts are ``bigint``; ranks are ``int``; ties rank by object ascending;
* every computed column is aliased to the name its SQL oracle uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.text import EXCLAIM, QUESTION, REQUEST_EXCLAIM, suffix
from tidepool.operators import changelog as CL
from tidepool.operators import counts as C
from tidepool.operators import distribution as D
from tidepool.operators import generators as G
from tidepool.operators import joins as J
from tidepool.operators import ranking as R
from tidepool.operators import reach as RE
from tidepool.operators import udf as U
from tidepool.operators import windows as W
from tidepool.operators.ordered import quantile_chunk
from tidepool.sources.batches import cycled, with_batch_id, with_partitioned_batch_id
from tidepool.sources.choice import CLOJURE_SENTENCES, PARAMETERIZED_EXAMPLE, RANDOM_SENTENCES, choice_source
from tidepool.sources.requests import requests_from
from tidepool.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

HOUR = 3600
DAY = 86400

# Fixed parameters of the named queries.
ROLLING_TOP_WINDOW = 9 * HOUR      # the example's 9 s / 3 s / top 5, in hours
ROLLING_TOP_EMIT = 3 * HOUR
ROLLING_TOP_N = 5
SLIDING_WINDOW = 6 * HOUR
SLIDING_SLIDE = 1 * HOUR
ROLLING_WINDOW = 5 * HOUR          # the default 5-chunk shape (300 s / 60 s), in hours
ROLLING_EMIT = 1 * HOUR
TRACKED_MARKS = 3
TOP_N = 10
GROUPS = 4
GROUP_TOP_N = 3
WINDOW_TOP_N = 5
BATCH_SIZE = 100
PARTITIONS = 3
PARTITION_TAKE = 100
JOIN_TIMEOUT = DAY
CYCLES = 2


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table(spark, sf, name)


# ------------------------------------------------------------ windows (W*)
def rolling_top_words(spark, sf):
    ev = _t(spark, sf, "events")
    rc = W.rolling_count(ev, "event_type", "ts", ROLLING_TOP_WINDOW, ROLLING_TOP_EMIT)
    top = R.rank_per_group(rc, ["window_start", "window_end"], "obj", "count", ROLLING_TOP_N)
    return top.select("window_start", "window_end", "rank", "obj", "count",
                      "actual_window_length_seconds", "is_partial_window")


def sliding_count(spark, sf):
    ev = _t(spark, sf, "events")
    return W.sliding_count(ev, "event_type", "ts", SLIDING_WINDOW, SLIDING_SLIDE)


def sliding_count_slots(spark, sf):
    ev = _t(spark, sf, "events")
    return W.sliding_count_slots(ev, "event_type", "ts", SLIDING_WINDOW, SLIDING_SLIDE)


def rolling_count(spark, sf):
    ev = _t(spark, sf, "events")
    return W.rolling_count(ev, "user_id", "ts", ROLLING_WINDOW, ROLLING_EMIT)


def _day_slots(spark, sf):
    return W.slot_counts(_t(spark, sf, "events"), "user_id", "ts", DAY)


def slot_counts(spark, sf):
    return _day_slots(spark, sf)


def slot_totals(spark, sf):
    return W.slot_totals(_day_slots(spark, sf))


def slot_totals_excluding(spark, sf):
    return W.slot_totals_excluding(_day_slots(spark, sf), W.oldest_slot(_t(spark, sf, "events"), "ts", DAY))


def slot_totals_nonzero(spark, sf):
    oldest = W.oldest_slot(_t(spark, sf, "events"), "ts", DAY)
    return W.slot_totals_excluding(_day_slots(spark, sf), oldest, drop_zeros=True)


def nth_last_modified(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id", "ts")
    return W.nth_last_modified(ev, "user_id", "ts", "event_id", TRACKED_MARKS,
                               chunk=quantile_chunk(ev, "ts"))


def nth_before_mark(spark, sf):
    """The tracker read before the row's own mark, as the rolling counter reads it."""
    ev = _t(spark, sf, "events").select("event_id", "user_id", "ts")
    return W.nth_last_modified(ev, "user_id", "ts", "event_id", TRACKED_MARKS, chunk=quantile_chunk(ev, "ts"),
                               before_mark=True)


def slot_lookup(spark, sf):
    """Every user's count in the slot of every day that has events: 0 on a miss."""
    counts = _day_slots(spark, sf)
    first, last = (counts.agg(f("slot_start")).scalar() for f in (F.min, F.max))
    # every day between the two ends, a day a step; the join keeps those that have events
    days = F.sequence(first, last, F.expr(f"make_dt_interval(0, 0, 0, {DAY})"))
    probes = (counts.select("obj").distinct().select("obj", F.explode(days).alias("slot_start"))
              .join(counts.select("slot_start").distinct(), "slot_start", "left_semi"))
    return W.slot_count_lookup(counts, probes)


# ------------------------------------------------------- counts and text
def running_count(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "ts", F.col("event_type").alias("word"))
    out = C.running_count(ev, "word", ["ts", "event_id"], quantile_chunk(ev, "ts"))
    return out.select("event_id", "word", "count")


def _java_words(spark, sf, name="documents"):
    return G.tokens(_t(spark, sf, name), "text", "java")


def word_count(spark, sf):
    return C.word_count(_java_words(spark, sf))


def merge_streams(spark, sf):
    docs = _t(spark, sf, "documents").select("text")
    conv = _t(spark, sf, "conversations").select("text")
    merged = D.merge_streams([docs, conv], ["sentence"])
    return C.word_count(G.tokens(merged, "sentence", "java"))


def split_java(spark, sf):
    return G.token_counts(_t(spark, sf, "documents"), "doc_id", "text", "java")


def split_python(spark, sf):
    return G.token_counts(_t(spark, sf, "documents"), "doc_id", "text", "python")


def split_whitespace(spark, sf):
    return G.token_counts(_t(spark, sf, "documents"), "doc_id", "text", "whitespace")


def expand_list(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    lines = G.expand_list(docs, "lines", "line")
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.sum(F.length("line")).cast("long").alias("line_chars"))


# ------------------------------------------------------------ projections
def exclaim_twice(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", F.col("event_type").alias("word"))
    once = ev.withColumn("word", suffix("word", EXCLAIM))
    return once.withColumn("word", suffix("word", EXCLAIM))


def question_twice(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", F.col("event_type").alias("word"))
    return ev.transform(lambda d: d.withColumn("word", suffix("word", QUESTION))) \
             .transform(lambda d: d.withColumn("word", suffix("word", QUESTION)))


def _customer_requests(spark, sf):
    return requests_from(_t(spark, sf, "customer"), "c_custkey", "c_name")


def req_exclaim(spark, sf):
    r = _customer_requests(spark, sf)
    return r.select("request_id", suffix("args", REQUEST_EXCLAIM).alias("result"))


def req_exclaim3(spark, sf):
    r = _customer_requests(spark, sf)
    return r.select(suffix("args", EXCLAIM).alias("result"), F.col("request_id").alias("return_info"))


# ---------------------------------------------------------------- ranking
def _supplier_counts(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("obj")).agg(
        F.count(F.lit(1)).alias("count"), F.count_distinct("l_partkey").alias("n_parts"))


def _supplier_year_counts(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("obj"), F.year("l_shipdate").alias("seq")).agg(
        F.count(F.lit(1)).alias("count"))


def topn(spark, sf):
    return R.rank_top(_supplier_counts(spark, sf).select("obj", "count"), "obj", "count", TOP_N) \
        .select("rank", "obj", "count")


def topn_with_fields(spark, sf):
    return R.rank_top(_supplier_counts(spark, sf), "obj", "count", TOP_N) \
        .select("rank", "obj", "count", "n_parts")


def topn_latest(spark, sf):
    latest = R.latest_counts(_supplier_year_counts(spark, sf), "obj", "count", "seq", carry=["seq"])
    return R.rank_top(latest, "obj", "count", TOP_N).select("rank", "obj", "count", "seq")


def topn_per_group(spark, sf):
    c = _supplier_counts(spark, sf).select("obj", "count").withColumn("grp", F.col("obj") % GROUPS)
    return R.rank_per_group(c, ["grp"], "obj", "count", GROUP_TOP_N).select("grp", "rank", "obj", "count")


def topn_two_phase(spark, sf):
    c = _supplier_counts(spark, sf).select("obj", "count")
    return R.rank_two_phase(c, "obj", "count", TOP_N, bucket=F.col("obj") % GROUPS).select("rank", "obj", "count")


def _yearly_rankings(spark, sf):
    return R.rank_per_group(_supplier_year_counts(spark, sf), ["seq"], "obj", "count", TOP_N)


def merge_rankings(spark, sf):
    partial = _yearly_rankings(spark, sf).select("obj", "count", "seq")
    return R.merge_rankings([partial], "obj", "count", "seq", TOP_N).select("rank", "obj", "count")


def rank_distinct(spark, sf):
    items = _yearly_rankings(spark, sf).select("obj", "count", "seq")
    return R.rank_distinct(items, "obj", "count", first_by="seq").withColumnRenamed("seq", "first_seq")


def rank_valid_rows(spark, sf):
    cu = _t(spark, sf, "customer").select(F.col("c_name").alias("obj"),
                                          F.floor("c_acctbal").cast("long").alias("count"))
    valid = R.validate_items(cu, "obj", "count", on_invalid="drop")
    return R.rank_top(valid, "obj", "count", TOP_N).select("rank", "obj", "count")


def _rendered(spark, sf):
    top = R.rank_top(_supplier_counts(spark, sf), "obj", "count", TOP_N)
    top = R.with_fields(top, ["n_parts"])
    return R.ranking_rendered(top, "obj", "count", "fields")


def rank_render(spark, sf):
    return _rendered(spark, sf).select("rank", "item")


def rank_render_list(spark, sf):
    return R.ranking_list_rendered(_rendered(spark, sf))


def topn_per_window(spark, sf):
    ev = _t(spark, sf, "events")
    daily = (ev.groupBy(F.window("ts", "1 day").alias("w"), F.col("user_id").alias("obj"))
             .agg(F.count(F.lit(1)).alias("count"))
             .select(F.col("w.start").alias("window_start"), "obj", "count"))
    return R.rank_per_group(daily, ["window_start"], "obj", "count", WINDOW_TOP_N) \
        .select("window_start", "rank", "obj", "count")


# ------------------------------------------------------ reach and lookups
def _reach_inputs(spark, sf):
    """request = an order; hop 1: order -> parts on it; hop 2: part -> the
    customers who ever ordered it.  reach = distinct customers reached."""
    orders = _t(spark, sf, "orders")
    li = _t(spark, sf, "lineitem")
    requests = orders.select(F.col("o_orderkey").alias("request_id"), F.col("o_orderkey").alias("url"))
    hop1 = li.select(F.col("l_orderkey").alias("url"), F.col("l_partkey").alias("tweeter"))
    hop2 = (li.select("l_orderkey", "l_partkey")
            .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_partkey").alias("tweeter"), F.col("o_custkey").alias("follower"))
            .dropDuplicates(["tweeter", "follower"]))
    return requests, hop1, hop2


def reach(spark, sf):
    req, h1, h2 = _reach_inputs(spark, sf)
    return RE.reach(req, h1, h2, out="reach", method="lists")


def reach_count(spark, sf):
    req, h1, h2 = _reach_inputs(spark, sf)
    return RE.reach(req, h1, h2, out="count", method="uniquer")


def reach_group_sum(spark, sf):
    req, h1, h2 = _reach_inputs(spark, sf)
    return RE.reach(req, h1, h2, out="reach", method="group_one")


def group_one(spark, sf):
    return C.group_one(_t(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


def map_get(spark, sf):
    req = _t(spark, sf, "customer").select(F.col("c_custkey").alias("request_id"))
    return J.map_get(req, _t(spark, sf, "orders"), "request_id", "o_custkey", ["o_orderkey"])


def _words_lookup(spark, sf):
    counts = C.word_count(_java_words(spark, sf))
    bench = _t(spark, sf, "benchmark")
    reqs = requests_from(bench, "item_id", "text")
    words = G.tokens(reqs, "args", "java", keep=("request_id",))
    return RE.lookup_sum(words, counts, requests=reqs)


def words_query(spark, sf):
    return _words_lookup(spark, sf)[1]


def filter_null(spark, sf):
    return _words_lookup(spark, sf)[0].select("request_id", "word", "count")


# ------------------------------------------------------------------ joins
def _join_sides(spark, sf):
    cu = _t(spark, sf, "customer")
    orders = _t(spark, sf, "orders")
    seg = cu.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    n_orders = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n_orders"))
    return cu, orders, seg, n_orders


def single_join(spark, sf):
    _, _, seg, n_orders = _join_sides(spark, sf)
    return J.single_join([seg, n_orders], ["id", "segment", "n_orders"], keys=["id"])


def single_join_natural(spark, sf):
    cu, _, seg, n_orders = _join_sides(spark, sf)
    nat = (cu.join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
           .select(F.col("c_custkey").alias("id"), F.col("n_name").alias("nation")))
    return J.single_join([seg, n_orders, nat], ["id", "segment", "n_orders", "nation"])


def single_join_nullsafe(spark, sf):
    cu, orders, _, _ = _join_sides(spark, sf)
    seg_or_null = F.when(F.col("c_mktsegment") != F.lit("BUILDING"), F.col("c_mktsegment"))
    a = cu.select(F.col("c_custkey").alias("id"), seg_or_null.alias("seg"), F.col("c_name").alias("name"))
    b = (orders.join(cu, F.col("o_custkey") == F.col("c_custkey"))
         .groupBy(F.col("c_custkey").alias("id"), seg_or_null.alias("seg"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    return J.single_join([a, b], ["id", "seg", "name", "n_orders"], keys=["id", "seg"], null_safe=True)


def _first_per_user(spark, sf, event_type, ts_name):
    ev = _t(spark, sf, "events")
    return (ev.filter(F.col("event_type") == F.lit(event_type))
            .groupBy("user_id").agg(F.min("ts").alias(ts_name)))


def single_join_timeout(spark, sf):
    signup = _first_per_user(spark, sf, "signup", "signup_ts")
    click = _first_per_user(spark, sf, "click", "click_ts")
    return J.interval_join(signup, click, ["user_id"], "signup_ts", "click_ts", JOIN_TIMEOUT) \
        .select("user_id", "signup_ts", "click_ts")


def join_expired(spark, sf):
    signup = _first_per_user(spark, sf, "signup", "signup_ts")
    click = _first_per_user(spark, sf, "click", "click_ts")
    return J.join_expired(signup, click, ["user_id"], "signup_ts", "click_ts", JOIN_TIMEOUT,
                          names=("signup", "click"))


def single_join_three_sides(spark, sf):
    """A user's first signup, click and purchase as three sides with the time-out."""
    sides = {n: _first_per_user(spark, sf, n, "ts") for n in ("signup", "click", "purchase")}
    return J.single_join_outcome(sides, ["user_id"], "ts", JOIN_TIMEOUT)


def join_duplicate_keys(spark, sf):
    ev = _t(spark, sf, "events")
    signup = ev.filter(F.col("event_type") == F.lit("signup")).select("user_id", "ts")
    click = ev.filter(F.col("event_type") == F.lit("click")).select("user_id", "ts")
    return J.duplicate_keys([signup, click], ["user_id"], names=["signup", "click"])


# ---------------------------------------------- batches and changelogs
def src_fixed_batches(spark, sf):
    ev = _t(spark, sf, "events").select("event_id")
    return with_batch_id(ev, ["event_id"], BATCH_SIZE, quantile_chunk(ev, "event_id"))


def _partitioned(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id",
                                        (F.col("user_id") % PARTITIONS).alias("part"))
    return with_partitioned_batch_id(ev, "part", ["event_id"], PARTITION_TAKE, quantile_chunk(ev, "event_id"))


def src_partitioned_batches(spark, sf):
    return _partitioned(spark, sf).select("event_id", "part", "batch_id")


def batch_count(spark, sf):
    return C.batch_count(_partitioned(spark, sf))


def keyed_batch_count(spark, sf):
    return C.keyed_batch_count(_partitioned(spark, sf), "user_id")


def src_cycled(spark, sf):
    """The fixed-batch source replayed twice: rows per batch and replay."""
    b = cycled(src_fixed_batches(spark, sf), CYCLES)
    return b.groupBy("cycle", "batch_id").agg(F.count(F.lit(1)).alias("count"))


def global_count(spark, sf):
    b = _partitioned(spark, sf)
    return C.global_count(C.batch_count(b), batches=b).select("batch_id", "count", "global_count")


def _changelog(spark, sf):
    b = _partitioned(spark, sf).select("batch_id", F.col("user_id").alias("key"))
    return CL.count_changelog(b, "key")


def count_changelog(spark, sf):
    return _changelog(spark, sf)


def bucket_deltas(spark, sf):
    return CL.bucket_deltas(_changelog(spark, sf))


def bucket_changelog(spark, sf):
    # The branches of the chained running sums share identical exchanges,
    # which adaptive execution reuses: events are scanned by two stages only
    # (checked in the event log), so nothing needs materialising here.
    return CL.bucket_changelog(CL.bucket_deltas(_changelog(spark, sf)), batches=_partitioned(spark, sf))


def count_histogram(spark, sf):
    return C.count_histogram(_t(spark, sf, "events").select(F.col("user_id").alias("key")), "key")


# ------------------------------------------------------------- sources
def src_random_sentence(spark, sf):
    return choice_source(_t(spark, sf, "events"), "event_id", RANDOM_SENTENCES)


def src_clojure_sentence(spark, sf):
    return choice_source(_t(spark, sf, "conversations").select(
        (F.col("conv_id") * F.lit(64) + F.col("turn")).alias("row_id")), "row_id", CLOJURE_SENTENCES, seed=3)


def src_param_choice(spark, sf):
    return choice_source(_t(spark, sf, "documents"), "doc_id", PARAMETERIZED_EXAMPLE, seed=7)


# --------------------------------------------------------- distribution
def dist_shuffle(spark, sf):
    return D.spread(_t(spark, sf, "events").select("event_id", "event_type"), 8)


def dist_fields(spark, sf):
    return D.by_fields(_t(spark, sf, "events").select("event_id", "user_id"), ["user_id"], 8)


def dist_all(spark, sf):
    """All grouping: each of PARTITIONS consumers counts every event type."""
    copies = D.copies_for(_t(spark, sf, "events").select("event_type"), PARTITIONS)
    return copies.groupBy("task", "event_type").agg(F.count(F.lit(1)).alias("count"))


def route_streams(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "event_type")
    routed = D.route(ev, {"alerts": F.col("event_type") == "error",
                          "commerce": F.col("event_type") == "purchase"})
    return routed.select("event_id", "stream")


# ------------------------------------------------------------ UDF surface
def udtf_split(spark, sf):
    toks = U.arrow_udtf_tokens(_t(spark, sf, "documents"), "doc_id", "text")
    return toks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


def map_in_arrow_split(spark, sf):
    return U.arrow_token_counts(_t(spark, sf, "documents"), "doc_id", "text")


def udaf_combiner(spark, sf):
    b = _partitioned(spark, sf).select("batch_id", "event_id")
    return U.combine_by_key(b, ["batch_id"], "event_id", U.COUNT, out="count")


def udaf_global(spark, sf):
    """A combiner over all rows, its zero over none."""
    orders = _t(spark, sf, "orders").select("o_orderkey")
    none = orders.where(F.col("o_orderkey") < 0)
    some = U.combine_all(orders, "o_orderkey", U.COUNT, out="count").withColumn("input", F.lit("orders"))
    return some.unionByName(U.combine_all(none, "o_orderkey", U.COUNT, out="count").withColumn("input", F.lit("none")))


def udaf_batch(spark, sf):
    b = _partitioned(spark, sf).select("batch_id", "event_id")
    return U.batch_aggregate(b, "batch_id", "event_id", U.count_rows, out="count")


QUERIES: dict[str, Query] = {
    "rolling_top_words": rolling_top_words,
    "sliding_count": sliding_count,
    "sliding_count_slots": sliding_count_slots,
    "rolling_count": rolling_count,
    "slot_counts": slot_counts,
    "slot_totals": slot_totals,
    "slot_totals_excluding": slot_totals_excluding,
    "slot_totals_nonzero": slot_totals_nonzero,
    "nth_last_modified": nth_last_modified,
    "nth_before_mark": nth_before_mark,
    "slot_lookup": slot_lookup,
    "keyed_batch_count": keyed_batch_count,
    "src_cycled": src_cycled,
    "src_clojure_sentence": src_clojure_sentence,
    "dist_all": dist_all,
    "udaf_global": udaf_global,
    "running_count": running_count,
    "word_count": word_count,
    "merge_streams": merge_streams,
    "split_java": split_java,
    "split_python": split_python,
    "split_whitespace": split_whitespace,
    "expand_list": expand_list,
    "exclaim_twice": exclaim_twice,
    "question_twice": question_twice,
    "req_exclaim": req_exclaim,
    "req_exclaim3": req_exclaim3,
    "topn": topn,
    "topn_with_fields": topn_with_fields,
    "topn_latest": topn_latest,
    "topn_per_group": topn_per_group,
    "topn_two_phase": topn_two_phase,
    "merge_rankings": merge_rankings,
    "rank_distinct": rank_distinct,
    "rank_valid_rows": rank_valid_rows,
    "rank_render": rank_render,
    "rank_render_list": rank_render_list,
    "topn_per_window": topn_per_window,
    "reach": reach,
    "reach_count": reach_count,
    "reach_group_sum": reach_group_sum,
    "group_one": group_one,
    "map_get": map_get,
    "words_query": words_query,
    "filter_null": filter_null,
    "single_join": single_join,
    "single_join_natural": single_join_natural,
    "single_join_nullsafe": single_join_nullsafe,
    "single_join_timeout": single_join_timeout,
    "join_expired": join_expired,
    "single_join_three_sides": single_join_three_sides,
    "join_duplicate_keys": join_duplicate_keys,
    "src_fixed_batches": src_fixed_batches,
    "src_partitioned_batches": src_partitioned_batches,
    "batch_count": batch_count,
    "global_count": global_count,
    "count_changelog": count_changelog,
    "bucket_deltas": bucket_deltas,
    "bucket_changelog": bucket_changelog,
    "count_histogram": count_histogram,
    "src_random_sentence": src_random_sentence,
    "src_param_choice": src_param_choice,
    "dist_shuffle": dist_shuffle,
    "dist_fields": dist_fields,
    "route_streams": route_streams,
    "udtf_split": udtf_split,
    "map_in_arrow_split": map_in_arrow_split,
    "udaf_combiner": udaf_combiner,
    "udaf_batch": udaf_batch,
}
