"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = (r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n,
         array_to_string(ws[s : s + least(10, len(ws)) - 1], ' ') AS w
  FROM i, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS t(s) WHERE len(ws) > 0),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, s, array_to_string(ws[s : s + n - 1], ' ') AS w
  FROM d, lens, unnest(range(1, greatest(len(ws) - n, -1) + 2)) AS t(s)),
hit AS (SELECT dw.doc_id, dw.s, dw.n, iw.item_id FROM dw JOIN iw USING (n, w)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

CHAT_FORMAT = """
WITH m AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
k AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS k FROM m),
r AS (
  SELECT k.*, p.perspective, k.role = p.perspective AS own,
         CASE WHEN k.role = p.perspective THEN '<|assistant|>' WHEN k.role = 'system' THEN '<|system|>'
              ELSE '<|user name=' || k.role || '|>' END || chr(10) AS head,
         k.text || '<|end|>' || chr(10) AS body
  FROM k JOIN (SELECT DISTINCT conv_id, role AS perspective FROM m WHERE role <> 'system') p
    ON k.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (
    PARTITION BY conv_id, perspective ORDER BY k ROWS UNBOUNDED PRECEDING) AS upto FROM r)
SELECT conv_id, CAST(k // 64 AS BIGINT) AS part, perspective, count(*) AS n_turns,
       CAST(min(upto - length(head) - length(body)) AS BIGINT) AS start, CAST(sum(length(head) + length(body)) AS BIGINT) AS n_chars,
       string_agg(head || body, '' ORDER BY k) AS text,
       coalesce(string_agg(CAST(upto - length(body) AS BIGINT)::VARCHAR || ':' || CAST(upto AS BIGINT)::VARCHAR, ','
                           ORDER BY k) FILTER (own), '') AS mask
FROM o GROUP BY conv_id, k // 64, perspective
"""

FILL_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, ls, CAST(len(ls) AS BIGINT) AS n, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4,
         CAST('0x' || h[1:8] AS BIGINT) % (len(ls) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(ls) + 1) AS y FROM d),
c AS (
  SELECT *, array_to_string(ls[1:least(x, y)], '') AS p, array_to_string(ls[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(ls[greatest(x, y) + 1:], '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM c
"""


def _centroids(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> str:
    """Lloyd's rounds one after the other, all distances taken."""
    # ids repeat, so vectors are numbered
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: isfinite(CAST(x AS DOUBLE)))) = {dim}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (
    SELECT x, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, x LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, list_sum(list_transform(range(1, {dim + 1}), lambda i: (v.x[i] - m.x[i]) * (v.x[i] - m.x[i]))) AS d
    FROM v, c{r} m) GROUP BY r)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(y, c{r}.x) AS x FROM c{r} LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS y FROM (
      SELECT c, i, sum(v.x[i]) AS s, count(*) AS n FROM v JOIN a{r} USING (r), range(1, {dim + 1}) AS t(i) GROUP BY c, i)
    GROUP BY c) USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} m USING (c)
"""


CENTROIDS = _centroids()
