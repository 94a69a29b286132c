"""Two-hop lookup with distinct counting: "reach" (J3, J4, A5-A7, G5, Q9-Q13).

reach(url) = number of distinct followers of the accounts that posted url.
Every pending request is answered in one job:

    requests ⋈ hop1 (url -> tweeter) ⋈ hop2 (tweeter -> follower)
      -> distinct (request, follower) -> count per request

The lookups are edge tables joined on their key -- never a driver-side map.
Duplicates after hop 1 are dropped to bound the fan-out of hop 2.  The
followers of a tweeter travel as sorted lists (``packed``) and are made
distinct per request where these lists meet, so what is shuffled grows with
the edges, not with the paths; that is the reference's partial uniquer.  A
request of more followers than a task holds leaves as (request, follower)
rows, which the last step makes distinct.  Requests with no match get 0
(decision D4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.packed import lists_of, union_per_key

#: Followers of a request that the task uniting its lists holds from one piece to the next.
LIST_PATHS = 4_096


def reach_pairs(requests: DataFrame, hop1: DataFrame, hop2: DataFrame) -> DataFrame:
    """(request_id, follower) rows, one per path (not yet distinct).

    ``requests(request_id, url)``, ``hop1(url, tweeter)``, ``hop2(tweeter, follower)``.

    One plan at any size: hop 1 is deduplicated on (request, tweeter), hop 2 is
    joined on tweeter (AQE picks the join from measured sizes and splits a hot
    tweeter), and the pairs are aggregated on (request, follower) by the
    distinct count, partially before its shuffle.
    """
    hop1_rows = requests.join(hop1, "url", "inner").select("request_id", "tweeter")
    tweeters = hop1_rows.dropDuplicates(["request_id", "tweeter"])
    return tweeters.join(hop2, "tweeter", "inner").select("request_id", "follower")


def reach_united(requests: DataFrame, hop1: DataFrame, hop2: DataFrame, most: int, nulls: bool) -> DataFrame:
    """``(request_id, pair, n, follower)``: each request's followers, one shuffled row per
    (request, tweeter) and ``PART`` followers instead of one per path.

    Hop 1 is deduplicated on (request, tweeter), the followers of a tweeter
    travel as sorted lists, and the lists of a request are united in one task:
    a row with the number ``n`` of its followers, or -- where these are more
    than ``most`` and not at hand at once -- rows (``pair``) that are still to
    be made distinct.  ``nulls``: a null follower counts as one."""
    tweeters = requests.join(hop1, "url", "inner").select("request_id", "tweeter").dropDuplicates(["request_id", "tweeter"])
    lists = tweeters.where("request_id is not null").join(lists_of(hop2, "tweeter", "follower"), "tweeter", "inner")
    return union_per_key(lists, "request_id", "follower", hop2.schema["follower"].dataType, most, nulls)


def reach(requests: DataFrame, hop1: DataFrame, hop2: DataFrame, out: str = "reach",
          method: str = "distinct", most: int = LIST_PATHS) -> DataFrame:
    """One row per request: ``(request_id, <out>)``.

    ``method``:
      * ``distinct``, ``lists`` -- ``count(DISTINCT follower)``
      * ``uniquer``   -- explicit ``dropDuplicates`` then ``count``
      * ``group_one`` -- group by follower, each group counts as one, then sum
      * ``approx``    -- HyperLogLog estimate, for when an estimate suffices

    The exact methods unite lists per request first (``reach_united``): a request
    of at most ``most`` followers comes to their last step as one row.
    """
    if method not in ("distinct", "uniquer", "group_one", "lists", "approx"):
        raise ValueError("method must be distinct, uniquer, group_one, lists or approx")
    if method == "approx":
        counts = (reach_pairs(requests, hop1, hop2).groupBy("request_id")
                  .agg(F.approx_count_distinct("follower").alias("_tp_n")))
    elif method == "uniquer":
        counts = (reach_united(requests, hop1, hop2, most, nulls=True).dropDuplicates(["request_id", "pair", "follower"])
                  .groupBy("request_id").agg(F.sum("n").alias("_tp_n")))
    elif method == "group_one":
        ones = (reach_united(requests, hop1, hop2, most, nulls=True)
                .groupBy("request_id", "pair", "follower").agg(F.max("n").alias("_tp_one")))
        counts = ones.groupBy("request_id").agg(F.sum("_tp_one").alias("_tp_n"))
    else:
        counts = (reach_united(requests, hop1, hop2, most, nulls=False).groupBy("request_id")
                  .agg((F.coalesce(F.sum(F.when(~F.col("pair"), F.col("n"))), F.lit(0))
                        + F.count_distinct("follower")).alias("_tp_n")))
    ids = requests.select("request_id").dropDuplicates(["request_id"])
    return (ids.join(counts, "request_id", "left")
            .select("request_id", F.coalesce(F.col("_tp_n"), F.lit(0)).cast("long").alias(out)))


def lookup_sum(request_words: DataFrame, counts: DataFrame, requests: DataFrame | None = None,
               word: str = "word", count: str = "count", out: str = "sum") -> tuple[DataFrame, DataFrame]:
    """J4 + P13 + A5 (the read path of the persistent word count).

    ``request_words(request_id, word)`` -- one row per word occurrence (D13);
    ``counts(word, count)`` -- the current aggregate state.
    Returns ``(found, sums)``: the looked-up rows that survive the null filter,
    and one ``sum`` per request (0 when nothing was found, the Sum zero).
    Pass ``requests`` so that a request without any word still gets its row.
    """
    c = counts.select(F.col(word).alias("_tp_w"), F.col(count).alias(count))
    looked = request_words.join(c, request_words[word] == c["_tp_w"], "left").drop("_tp_w")
    found = looked.filter(F.col(count).isNotNull())
    sums = found.groupBy("request_id").agg(F.sum(count).alias("_tp_s"))
    ids = (requests if requests is not None else request_words).select("request_id").dropDuplicates(["request_id"])
    return found, (ids.join(sums, "request_id", "left")
                   .select("request_id", F.coalesce(F.col("_tp_s"), F.lit(0)).cast("long").alias(out)))
