"""DuckDB SQL of the queries whose statements are too long for ``queries``."""

from __future__ import annotations


def _add(best: str, price: str, edit: str) -> str:
    """A partial repair, (cost in eight digits || audit), with one more edit.  Least texts are
    the cheapest repairs, ties by audit."""
    return f"lpad((left({best}, 8)::INT + {price})::VARCHAR, 8, '0') || substr({best}, 9) || {edit}"


def _to(state: str, token: str) -> str:
    """``state`` with the row kept or reroled as ``token`` (null where it must go)."""
    keep = f"CASE WHEN cls = '{token}' THEN 0 ELSE 2 END + CASE WHEN fault = 3 THEN 1 ELSE 0 END"
    return f"CASE WHEN fault IN (0, 3) THEN {_add(state, keep, f'''CASE WHEN cls = '{token}' THEN 'K' ELSE 'R' END''')} END"


_INS = {x: _add(x, "2", "'I'") for x in ("b0", "bs", "bu", "ba", "nu", "n0", "ns", "na")}

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE
tbl AS (SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
coded AS (SELECT src.*, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
              list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
              lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) % 20 AS code FROM src, tbl),
damaged AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
                   CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM coded, range(2) r(copy) WHERE code <> 0 AND (copy = 0 OR code = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                  right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final
           FROM damaged),
judged AS (SELECT *, CASE WHEN final = '' THEN 1
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                  WHEN final NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                  left(role, 1) AS cls,
                  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
           FROM placed),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
                  count(*) FILTER (WHERE fault = 3) AS truncated,
                  count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
           FROM judged GROUP BY conv_id),
walk AS (
    SELECT conv_id, 0::BIGINT AS i, '00000000' AS b0, NULL::VARCHAR AS bs, '00000002I' AS bu, '00000004II' AS ba
    FROM counts
    UNION ALL
    SELECT conv_id, i, n0, ns, nu, least(na, {_INS['nu']}) FROM (
        SELECT conv_id, i, n0, ns, na, least(nu, {_INS['n0']}, {_INS['ns']}, {_INS['na']}) AS nu FROM (
            SELECT j.conv_id, j.i, {_add('b0', '3', "'D'")} AS n0,
                   least({_add('bs', '3', "'D'")}, CASE WHEN cls = 's' THEN {_to('b0', 's')} END) AS ns,
                   least({_add('bu', '3', "'D'")}, {_to('b0', 'u')}, {_to('bs', 'u')}, {_to('ba', 'u')}) AS nu,
                   least({_add('ba', '3', "'D'")}, {_to('bu', 'a')}) AS na
            FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1))),
best AS (SELECT w.conv_id, least(b0, ba) AS b FROM walk w
         JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i),
edits AS (SELECT conv_id, k, substr(b, 8 + k, 1) AS e, length(replace(substr(b, 9, k), 'I', '')) AS i
          FROM (SELECT conv_id, b, unnest(range(1, length(b) - 7)) AS k FROM best)),
turns AS (SELECT e.conv_id, k, e, role, text, e = 'K' AND cls = 's' AS first
          FROM edits e LEFT JOIN judged j ON e <> 'I' AND j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.i = e.i
          WHERE e <> 'D'),
lines AS (SELECT conv_id, k, CASE WHEN e = 'K' THEN role
                 WHEN sum(CASE WHEN first THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY k) % 2 = 1
                 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line FROM turns),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS text FROM lines GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(left(b, 8)::BIGINT, 0) AS cost, coalesce(substr(b, 9), '') AS audit,
       sha256(coalesce(text, '')) AS repaired_sha256
FROM ids LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM ids.conv_id"""


def _round(r: int) -> str:
    """Assignment ``a<r>`` to the centroids ``c<r>`` and the centroids after it."""
    return f"""
d{r} AS (SELECT u, c, sum((comp.x - c{r}.x) * (comp.x - c{r}.x))::BIGINT AS d
         FROM comp JOIN c{r} ON comp.i = c{r}.i GROUP BY u, c),
a{r} AS MATERIALIZED (SELECT u, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY u ORDER BY d, c) = 1),
m{r} AS (SELECT c, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x FROM a{r} JOIN comp ON a{r}.u = comp.u GROUP BY c, i),
c{r + 1} AS MATERIALIZED (SELECT o.c, o.i, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN m{r} m ON o.c = m.c AND o.i = m.i)"""


CENTROID_CLUSTERS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
comp AS MATERIALIZED (SELECT u, unnest(range(1, 65)) AS i, unnest(v) AS x FROM kept),
first AS (SELECT u, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), v) - 1 AS c FROM kept
          QUALIFY c < 16),
c0 AS MATERIALIZED (SELECT c, i, x FROM first JOIN comp ON first.u = comp.u),{_round(0)},{_round(1)},{_round(2)},{_round(3)},
digest AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c3 GROUP BY c)
SELECT vec_id, a3.c::INT AS cluster, a3.d AS distance, sum(a3.d) OVER (PARTITION BY a3.c)::BIGINT AS cluster_inertia,
       sum(a3.d) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM a3 JOIN kept ON a3.u = kept.u JOIN digest ON a3.c = digest.c"""

TOPK_SEARCH = """
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT q.u, q.vec_id AS query_id, d.vec_id,
             coalesce(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
      FROM v q, v d WHERE q.vec_id % 100 = 0 AND q.u <> d.u)
SELECT query_id, row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""
