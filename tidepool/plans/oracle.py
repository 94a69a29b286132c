"""DuckDB SQL oracles for the named queries (same tables, same column names).

Written independently of the Spark plans: slot arithmetic on epoch
microseconds, explicit window expansion, plain window functions.  Counts are
cast to BIGINT (DuckDB's sum of integers is HUGEINT) and ranks to INTEGER.
"""

from __future__ import annotations

from tidepool.plans import catalog as Q
from tidepool.sources.choice import CLOJURE_SENTENCES, PARAMETERIZED_EXAMPLE, RANDOM_SENTENCES

_US = 1_000_000


def _java_split(col: str) -> str:
    return (f"(CASE WHEN {col} = '' THEN [''] "
            f"WHEN rtrim({col}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({col}, ' '), ' ') END)")


def _whitespace_split(col: str) -> str:
    return f"list_filter(regexp_split_to_array({col}, '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '')"


def _sliding(obj: str, window: int, slide: int) -> str:
    n = window // slide
    e = slide * _US
    return f"""
slots AS (
  SELECT {obj} AS obj, (epoch_us(ts) // {e}) * {e} AS slot_us, count(*) AS n
  FROM events GROUP BY ALL),
counts AS (
  SELECT obj, slot_us - k * {e} AS ws_us, CAST(sum(n) AS BIGINT) AS count
  FROM slots, range(0, {n}) t(k) GROUP BY ALL)"""


def _sliding_sql(obj: str, window: int, slide: int) -> str:
    n = window // slide
    e = slide * _US
    return f"""WITH {_sliding(obj, window, slide)}
SELECT make_timestamp(ws_us) AS window_start, make_timestamp(ws_us + {n * e}) AS window_end, obj, count
FROM counts"""


def _rolling_sql(obj: str, window: int, slide: int) -> str:
    n = window // slide
    e = slide * _US
    return f"""WITH {_sliding(obj, window, slide)},
start AS (SELECT min(slot_us) AS s0 FROM slots)
SELECT make_timestamp(ws_us) AS window_start, make_timestamp(ws_us + {n * e}) AS window_end, obj, count,
       CAST(least((ws_us + {n * e} - s0) // {_US}, {n * slide}) AS INTEGER) AS actual_window_length_seconds,
       least((ws_us + {n * e} - s0) // {_US}, {n * slide}) <> {window} AS is_partial_window
FROM counts, start"""


def _top(inner: str, n: int, extra: str = "") -> str:
    return f"""SELECT CAST(rank AS INTEGER) AS rank, obj, count{extra} FROM (
  SELECT *, row_number() OVER (ORDER BY count DESC, obj) AS rank FROM ({inner}) x) y
WHERE rank <= {n}"""


_SUPPLIER_COUNTS = ("SELECT l_suppkey AS obj, count(*) AS count, count(DISTINCT l_partkey) AS n_parts "
                    "FROM lineitem GROUP BY 1")
_SUPPLIER_YEAR_COUNTS = ("SELECT l_suppkey AS obj, CAST(year(l_shipdate) AS INTEGER) AS seq, count(*) AS count "
                         "FROM lineitem GROUP BY 1, 2")
_YEARLY_TOP = f"""SELECT obj, count, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY seq ORDER BY count DESC, obj) AS r FROM ({_SUPPLIER_YEAR_COUNTS}) c) p
WHERE r <= {Q.TOP_N}"""

_DAY_SLOTS = (f"SELECT user_id AS obj, make_timestamp((epoch_us(ts) // {Q.DAY * _US}) * {Q.DAY * _US}) AS slot_start, "
              f"count(*) AS count FROM events GROUP BY ALL")

_REACH_COUNTS = """
h1 AS (SELECT DISTINCT l_orderkey AS url, l_partkey AS tweeter FROM lineitem),
h2 AS (SELECT DISTINCT l.l_partkey AS tweeter, o.o_custkey AS follower
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
c AS (SELECT h1.url AS request_id, count(DISTINCT h2.follower) AS n
      FROM h1 JOIN h2 ON h1.tweeter = h2.tweeter GROUP BY 1)"""


def _reach_sql(col: str) -> str:
    return f"""WITH {_REACH_COUNTS}
SELECT o.o_orderkey AS request_id, CAST(coalesce(c.n, 0) AS BIGINT) AS {col}
FROM orders o LEFT JOIN c ON o.o_orderkey = c.request_id"""


_WORDS = f"""
wc AS (SELECT word, count(*) AS count FROM (SELECT unnest({_java_split('text')}) AS word FROM documents) GROUP BY word),
rw AS (SELECT item_id AS request_id, unnest({_java_split('text')}) AS word FROM benchmark),
found AS (SELECT rw.request_id, rw.word, wc.count FROM rw JOIN wc ON rw.word = wc.word)"""

_JOIN_SIDES = """
seg AS (SELECT c_custkey AS id, c_mktsegment AS segment FROM customer),
no AS (SELECT o_custkey AS id, count(*) AS n_orders FROM orders GROUP BY 1)"""

_FIRSTS = """
s AS (SELECT user_id, min(ts) AS signup_ts FROM events WHERE event_type = 'signup' GROUP BY 1),
c AS (SELECT user_id, min(ts) AS click_ts FROM events WHERE event_type = 'click' GROUP BY 1)"""
_T = f"INTERVAL {Q.JOIN_TIMEOUT} SECONDS"

_PARTITIONED = f"""
b AS (SELECT event_id, user_id, user_id % {Q.PARTITIONS} AS part,
             CAST((row_number() OVER (PARTITION BY user_id % {Q.PARTITIONS} ORDER BY event_id) - 1)
                  // {Q.PARTITION_TAKE} AS BIGINT) AS batch_id
      FROM events)"""

_CHANGELOG = f"""{_PARTITIONED},
per AS (SELECT batch_id, user_id AS key, count(*) AS n FROM b GROUP BY 1, 2),
run AS (SELECT batch_id, key, n, sum(n) OVER (PARTITION BY key ORDER BY batch_id) AS cum FROM per),
cl AS (SELECT batch_id, key, CAST(cum AS BIGINT) AS count,
              CAST(CASE WHEN cum - n = 0 THEN NULL ELSE cum - n END AS BIGINT) AS prev_count FROM run)"""

_DELTAS = f"""{_CHANGELOG},
d AS (
  SELECT batch_id, count // {10} AS bucket, 1 AS delta FROM cl
  WHERE prev_count IS NULL OR count // 10 <> prev_count // 10
  UNION ALL
  SELECT batch_id, prev_count // 10 AS bucket, -1 AS delta FROM cl
  WHERE prev_count IS NOT NULL AND count // 10 <> prev_count // 10)"""


def _choice_sql(id_col: str, table: str, vocab, seed: int) -> str:
    arr = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in vocab) + "]"
    x = f"(({id_col} + {seed}) % 2147483648)"
    mixed = f"(({x} * 1103515245 + 12345) % 2147483648)"
    return f"SELECT {id_col}, {arr}[CAST(({mixed} // 65536) % {len(vocab)} AS INTEGER) + 1] AS sentence FROM {table}"


_TOKENS_PER_DOC = "SELECT doc_id, CAST(len({split}) AS BIGINT) AS n_tokens FROM documents"

ORACLE: dict[str, str] = {
    "rolling_top_words": f"""SELECT window_start, window_end, CAST(rank AS INTEGER) AS rank, obj, count,
       actual_window_length_seconds, is_partial_window FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, obj) AS rank
  FROM ({_rolling_sql('event_type', Q.ROLLING_TOP_WINDOW, Q.ROLLING_TOP_EMIT)}) r) x
WHERE rank <= {Q.ROLLING_TOP_N}""",
    "sliding_count": _sliding_sql("event_type", Q.SLIDING_WINDOW, Q.SLIDING_SLIDE),
    "sliding_count_slots": _sliding_sql("event_type", Q.SLIDING_WINDOW, Q.SLIDING_SLIDE),
    "rolling_count": _rolling_sql("user_id", Q.ROLLING_WINDOW, Q.ROLLING_EMIT),
    "slot_counts": _DAY_SLOTS,
    "slot_totals": f"SELECT obj, CAST(sum(count) AS BIGINT) AS total FROM ({_DAY_SLOTS}) c GROUP BY obj",
    "slot_totals_excluding": f"""WITH c AS ({_DAY_SLOTS}), o AS (SELECT min(slot_start) AS m FROM c)
SELECT obj, CAST(sum(CASE WHEN slot_start = m THEN 0 ELSE count END) AS BIGINT) AS total FROM c, o GROUP BY obj""",
    "slot_totals_nonzero": f"""WITH c AS ({_DAY_SLOTS}), o AS (SELECT min(slot_start) AS m FROM c)
SELECT obj, CAST(sum(CASE WHEN slot_start = m THEN 0 ELSE count END) AS BIGINT) AS total FROM c, o GROUP BY obj
HAVING sum(CASE WHEN slot_start = m THEN 0 ELSE count END) > 0""",
    "nth_last_modified": f"""SELECT event_id, user_id, ts,
  CAST((epoch_us(ts) - epoch_us(coalesce(lag(ts, {Q.TRACKED_MARKS - 1}) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                                          (SELECT min(ts) FROM events)))) // {_US} AS INTEGER) AS seconds_since_oldest
FROM events""",
    "running_count": """SELECT event_id, event_type AS word,
  CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS BIGINT) AS count FROM events""",
    "word_count": f"""SELECT word, count(*) AS count FROM (
  SELECT unnest({_java_split('text')}) AS word FROM documents) GROUP BY word""",
    "merge_streams": f"""SELECT word, count(*) AS count FROM (
  SELECT unnest({_java_split('sentence')}) AS word FROM (
    SELECT text AS sentence FROM documents UNION ALL SELECT text AS sentence FROM conversations)) GROUP BY word""",
    "split_java": _TOKENS_PER_DOC.format(split=_java_split("text")),
    "split_python": _TOKENS_PER_DOC.format(split="string_split(text, ' ')"),
    "split_whitespace": _TOKENS_PER_DOC.format(split=_whitespace_split("text")),
    "expand_list": """SELECT doc_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS line_chars FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
    "exclaim_twice": "SELECT event_id, event_type || '!!!' || '!!!' AS word FROM events",
    "question_twice": "SELECT event_id, event_type || '???' || '???' AS word FROM events",
    "req_exclaim": "SELECT c_custkey AS request_id, c_name || '!' AS result FROM customer",
    "req_exclaim3": "SELECT c_name || '!!!' AS result, c_custkey AS return_info FROM customer",
    "topn": _top(f"SELECT obj, count FROM ({_SUPPLIER_COUNTS}) s", Q.TOP_N),
    "topn_with_fields": _top(_SUPPLIER_COUNTS, Q.TOP_N, ", n_parts"),
    "topn_latest": _top(f"""SELECT obj, arg_max(count, seq) AS count, max(seq) AS seq
  FROM ({_SUPPLIER_YEAR_COUNTS}) c GROUP BY obj""", Q.TOP_N, ", seq"),
    "topn_per_group": f"""SELECT grp, CAST(rank AS INTEGER) AS rank, obj, count FROM (
  SELECT obj % {Q.GROUPS} AS grp, obj, count,
         row_number() OVER (PARTITION BY obj % {Q.GROUPS} ORDER BY count DESC, obj) AS rank
  FROM ({_SUPPLIER_COUNTS}) s) x WHERE rank <= {Q.GROUP_TOP_N}""",
    "topn_two_phase": _top(f"SELECT obj, count FROM ({_SUPPLIER_COUNTS}) s", Q.TOP_N),
    "merge_rankings": _top(f"SELECT obj, arg_max(count, seq) AS count FROM ({_YEARLY_TOP}) p GROUP BY obj", Q.TOP_N),
    "rank_distinct": f"SELECT obj, count, min(seq) AS first_seq FROM ({_YEARLY_TOP}) p GROUP BY obj, count",
    "rank_valid_rows": _top("""SELECT obj, count FROM (
  SELECT c_name AS obj, CAST(floor(c_acctbal) AS BIGINT) AS count FROM customer) c
  WHERE obj IS NOT NULL AND count >= 0""", Q.TOP_N),
    "rank_render": f"""SELECT rank, '[' || obj || '|' || count || '|' || n_parts || ']' AS item
FROM ({_top(_SUPPLIER_COUNTS, Q.TOP_N, ', n_parts')}) t""",
    "rank_render_list": f"""SELECT '[' || string_agg('[' || obj || '|' || count || '|' || n_parts || ']', ', ' ORDER BY rank) || ']'
  AS rankings FROM ({_top(_SUPPLIER_COUNTS, Q.TOP_N, ', n_parts')}) t""",
    "topn_per_window": f"""SELECT window_start, CAST(rank AS INTEGER) AS rank, obj, count FROM (
  SELECT window_start, obj, count, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, obj) AS rank
  FROM (SELECT date_trunc('day', ts) AS window_start, user_id AS obj, count(*) AS count FROM events GROUP BY 1, 2) d
) x WHERE rank <= {Q.WINDOW_TOP_N}""",
    "reach": _reach_sql("reach"),
    "reach_count": _reach_sql("count"),
    "reach_group_sum": _reach_sql("reach"),
    "group_one": "SELECT DISTINCT l_orderkey, l_partkey, 1 AS one FROM lineitem",
    "map_get": """SELECT c.c_custkey AS request_id, o.o_orderkey
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey""",
    "words_query": f"""WITH {_WORDS},
s AS (SELECT request_id, sum(count) AS s FROM found GROUP BY 1)
SELECT b.item_id AS request_id, CAST(coalesce(s.s, 0) AS BIGINT) AS sum
FROM benchmark b LEFT JOIN s ON b.item_id = s.request_id""",
    "filter_null": f"WITH {_WORDS} SELECT request_id, word, count FROM found",
    "single_join": f"""WITH {_JOIN_SIDES}
SELECT seg.id, seg.segment, no.n_orders FROM seg JOIN no ON seg.id = no.id""",
    "single_join_natural": f"""WITH {_JOIN_SIDES},
nat AS (SELECT c_custkey AS id, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT seg.id, seg.segment, no.n_orders, nat.nation
FROM seg JOIN no ON seg.id = no.id JOIN nat ON seg.id = nat.id""",
    "single_join_nullsafe": """WITH
a AS (SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS seg, c_name AS name
      FROM customer),
b AS (SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS seg, count(*) AS n_orders
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT a.id, a.seg, a.name, b.n_orders FROM a JOIN b ON a.id = b.id AND a.seg IS NOT DISTINCT FROM b.seg""",
    "single_join_timeout": f"""WITH {_FIRSTS}
SELECT s.user_id, s.signup_ts, c.click_ts FROM s JOIN c ON s.user_id = c.user_id
 AND c.click_ts >= s.signup_ts - {_T} AND c.click_ts <= s.signup_ts + {_T}""",
    "join_expired": f"""WITH {_FIRSTS}
SELECT 'signup' AS side, s.user_id, s.signup_ts AS ts FROM s WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE c.user_id = s.user_id AND c.click_ts >= s.signup_ts - {_T} AND c.click_ts <= s.signup_ts + {_T})
UNION ALL
SELECT 'click' AS side, c.user_id, c.click_ts AS ts FROM c WHERE NOT EXISTS (
  SELECT 1 FROM s WHERE c.user_id = s.user_id AND c.click_ts >= s.signup_ts - {_T} AND c.click_ts <= s.signup_ts + {_T})""",
    "single_join_three_sides": f"""WITH f AS (
  SELECT user_id, event_type AS side, min(ts) AS ts FROM events WHERE event_type IN ('signup', 'click', 'purchase') GROUP BY 1, 2),
k AS (SELECT user_id, count(*) = 3 AND max(ts) - min(ts) <= {_T} AS complete, max(ts) AS last FROM f GROUP BY 1)
SELECT 'joined' AS status, CAST(NULL AS VARCHAR) AS side, user_id, last AS ts FROM k WHERE complete
UNION ALL
SELECT 'expired', side, user_id, ts FROM f JOIN k USING (user_id) WHERE NOT complete""",
    "join_duplicate_keys": """SELECT 'signup' AS side, user_id, count(*) AS n FROM events WHERE event_type = 'signup'
  GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'click' AS side, user_id, count(*) AS n FROM events WHERE event_type = 'click'
  GROUP BY user_id HAVING count(*) > 1""",
    "src_fixed_batches": f"""SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // {Q.BATCH_SIZE} AS BIGINT)
  AS batch_id FROM events""",
    "src_partitioned_batches": f"WITH {_PARTITIONED} SELECT event_id, part, batch_id FROM b",
    "batch_count": f"WITH {_PARTITIONED} SELECT batch_id, count(*) AS count FROM b GROUP BY 1",
    "global_count": f"""WITH {_PARTITIONED}, bc AS (SELECT batch_id, count(*) AS count FROM b GROUP BY 1)
SELECT batch_id, count, CAST(sum(count) OVER (ORDER BY batch_id) AS BIGINT) AS global_count FROM bc""",
    "count_changelog": f"WITH {_CHANGELOG} SELECT batch_id, key, count, prev_count FROM cl",
    "bucket_deltas": f"WITH {_DELTAS} SELECT batch_id, bucket, delta FROM d",
    "bucket_changelog": f"""WITH {_DELTAS},
bper AS (SELECT batch_id, bucket, sum(delta) AS s FROM d GROUP BY 1, 2)
SELECT batch_id, bucket, CAST(sum(s) OVER (PARTITION BY bucket ORDER BY batch_id) AS BIGINT) AS count FROM bper""",
    "count_histogram": """SELECT n // 10 AS bucket, count(*) AS count FROM (
  SELECT user_id, count(*) AS n FROM events GROUP BY 1) GROUP BY 1""",
    "src_random_sentence": _choice_sql("event_id", "events", RANDOM_SENTENCES, 0),
    "src_clojure_sentence": _choice_sql(
        "row_id", "(SELECT conv_id * 64 + turn AS row_id FROM conversations)", CLOJURE_SENTENCES, 3),
    "keyed_batch_count": f"WITH {_PARTITIONED} SELECT batch_id, user_id, count(*) AS count FROM b GROUP BY 1, 2",
    "src_cycled": f"""SELECT CAST(cycle AS BIGINT) AS cycle, batch_id, count(*) AS count FROM (
  SELECT CAST((row_number() OVER (ORDER BY event_id) - 1) // {Q.BATCH_SIZE} AS BIGINT) AS batch_id FROM events), range({Q.CYCLES}) AS r(cycle)
GROUP BY 1, 2""",
    "dist_all": f"""SELECT CAST(task AS INTEGER) AS task, event_type, count(*) AS count FROM events, range({Q.PARTITIONS}) AS r(task)
GROUP BY 1, 2""",
    "udaf_global": """SELECT count(*) AS count, 'orders' AS input FROM orders
UNION ALL SELECT count(*), 'none' FROM orders WHERE o_orderkey < 0""",
    "slot_lookup": f"""WITH c AS ({_DAY_SLOTS})
SELECT o.obj, d.slot_start, coalesce(c.count, 0) AS count
FROM (SELECT DISTINCT obj FROM c) o CROSS JOIN (SELECT DISTINCT slot_start FROM c) d
LEFT JOIN c ON c.obj IS NOT DISTINCT FROM o.obj AND c.slot_start = d.slot_start""",
    "nth_before_mark": f"""SELECT event_id, user_id, ts,
  CAST((epoch_us(ts) - epoch_us(coalesce(lag(ts, {Q.TRACKED_MARKS}) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                                          (SELECT min(ts) FROM events)))) // {_US} AS INTEGER) AS seconds_since_oldest
FROM events""",
    "src_param_choice": _choice_sql("doc_id", "documents", PARAMETERIZED_EXAMPLE, 7),
    "dist_shuffle": "SELECT event_id, event_type FROM events",
    "dist_fields": "SELECT event_id, user_id FROM events",
    "route_streams": """SELECT event_id, CASE WHEN event_type = 'error' THEN 'alerts'
  WHEN event_type = 'purchase' THEN 'commerce' ELSE 'default' END AS stream FROM events""",
    "udtf_split": "SELECT doc_id, count(*) AS n_tokens FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1",
    "map_in_arrow_split": _TOKENS_PER_DOC.format(split="string_split(text, ' ')"),
    "udaf_combiner": f"WITH {_PARTITIONED} SELECT batch_id, count(*) AS count FROM b GROUP BY 1",
    "udaf_batch": f"WITH {_PARTITIONED} SELECT batch_id, count(*) AS count FROM b GROUP BY 1",
}
