"""DuckDB SQL for the queries of this package that SQL can express over whole tables."""

from __future__ import annotations

#: Words of a text: runs of characters that are neither a space nor one of code points 9 to 13.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words WHERE len(w) >= 13),
windows AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s FROM starts),
least AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM windows JOIN least USING (s) WHERE doc_id > first),
flags AS (SELECT doc_id, list(i) AS dead FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(dead), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN dead IS NULL THEN w ELSE
           list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(dead, x[2])), lambda x: x[1])
       END, ' ')) AS kept_sha256
FROM words LEFT JOIN flags USING (doc_id)
"""


_OP7 = f"""
WITH RECURSIVE texts AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT doc_id, {_WORDS} AS w FROM texts),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT doc_id, n, g FROM shingles WHERE g IN (SELECT g FROM shingles GROUP BY g HAVING count(*) > 1)),
likely AS (SELECT doc_id FROM common GROUP BY doc_id, n HAVING 100 * count(*) >= 80 * n),
kept AS (SELECT * FROM common SEMI JOIN likely USING (doc_id)),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM kept a JOIN kept b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached(node, root) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT links.b, reached.root FROM reached JOIN links ON reached.node = links.a AND links.b > reached.root)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, first)::BIGINT AS component_id
FROM sets JOIN (SELECT node, min(root) AS first FROM reached GROUP BY node) ON node = doc_id
"""

_OP8 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
"""

_OP10 = """
WITH RECURSIVE calls AS (
    SELECT conv_id, turn, 'c' || turn AS call_id, text,
           CASE WHEN (turn + conv_id) % 11 = 10 THEN 'missing' WHEN turn % 4 < 2 THEN 'search' ELSE 'lookup' END AS name,
           CASE WHEN conv_id % 3 = 0 OR (conv_id % 5 = 0 AND turn % 4 < 2) THEN turn + 2 WHEN turn >= 2 OR conv_id % 5 = 0 THEN turn - 2 END AS target
    FROM conversations WHERE role = 'user'),
results AS (SELECT conv_id, 'c' || (turn - 1) AS call_id, turn AS result_turn, text AS body FROM conversations WHERE role = 'assistant'),
edges AS (SELECT a.conv_id, a.turn AS user_turn, b.turn AS used_turn, (b.turn >= a.turn)::INT AS back FROM calls a JOIN calls b ON a.conv_id = b.conv_id AND a.target = b.turn),
needed AS (SELECT conv_id, sum(back) AS backward FROM edges GROUP BY conv_id HAVING sum(back) > 0),
walks(conv_id, turn, level, steps) AS (
    SELECT conv_id, turn, 0, 0 FROM calls WHERE conv_id IN (SELECT conv_id FROM needed)
    UNION
    SELECT e.conv_id, e.user_turn, w.level + e.back, w.steps + 1 FROM walks w JOIN edges e ON e.conv_id = w.conv_id AND e.used_turn = w.turn WHERE w.steps < 20),
levels AS (SELECT conv_id, turn, max(level) AS level, max(steps) AS steps FROM walks GROUP BY conv_id, turn),
fields AS (
    SELECT *, (turn + conv_id) % 7 = 6 AS worded, (turn + conv_id) % 13 = 12 AS added, (turn + conv_id) % 9 <> 8 AS texted FROM calls),
judged AS (
    SELECT conv_id, turn, call_id, name,
           '{' || CASE WHEN target IS NULL THEN '' ELSE '"after":{"$ref":"c' || target || '"},' END || CASE WHEN added THEN '"extra":true,' ELSE '' END
           || '"length":' || CASE WHEN worded THEN '"many"' ELSE length(text)::VARCHAR END
           || CASE WHEN texted THEN ',"text":' || to_json(text)::VARCHAR ELSE '' END || '}' AS arguments,
           CASE WHEN name = 'missing' THEN 'unknown_tool' WHEN NOT texted THEN 'missing:text'
                WHEN name = 'lookup' AND target IS NULL THEN 'missing:after' WHEN added THEN 'unexpected:extra' WHEN worded THEN 'type:length' END AS error
    FROM fields),
linked AS (
    SELECT coalesce(j.conv_id, r.conv_id) AS conv_id, coalesce(j.call_id, r.call_id) AS call_id, name, j.turn, result_turn, arguments,
           CASE WHEN r.conv_id IS NULL THEN 'null' ELSE '{"body":' || to_json(body)::VARCHAR || ',"count":' || length(body) || ',"even":'
                || CASE WHEN result_turn % 2 = 0 THEN 'true' ELSE 'false' END || '}' END AS content,
           CASE WHEN j.conv_id IS NULL THEN 'no_call' WHEN coalesce(l.steps, 0) >= 20 THEN 'cyclic' WHEN error IS NOT NULL THEN 'invalid ' || error
                WHEN r.conv_id IS NULL THEN 'no_result' ELSE 'ok' END AS status,
           coalesce(l.level, 0) AS level
    FROM judged j FULL JOIN results r ON j.conv_id = r.conv_id AND j.call_id = r.call_id LEFT JOIN levels l ON l.conv_id = j.conv_id AND l.turn = j.turn)
SELECT conv_id, call_id, name, CASE WHEN status NOT IN ('cyclic', 'no_call') THEN level END::INTEGER AS level, turn, result_turn, status,
       sha256('{"arguments":' || coalesce(arguments, 'null') || ',"id":"' || call_id || '","name":' || coalesce('"' || name || '"', 'null')
              || ',"result":' || content || '}') AS line_sha256
FROM linked
"""

_OP11 = """
WITH r AS (
    SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.rid, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, list_inner_product(a.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM r a JOIN r c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positives AS (
    SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS p
    FROM scores WHERE same QUALIFY p <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.rid, p.p ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.rid = p.rid AND NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY rank <= 3
"""

_OP12 = """
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
named AS (SELECT DISTINCT conv_id FROM conversations),
ids AS (SELECT conv_id, row_number() OVER () AS c FROM named),
coded AS (
    SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(v.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations v JOIN ids ON v.conv_id IS NOT DISTINCT FROM ids.conv_id),
drawn AS (
    SELECT c, turn, role, text, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: ord(k[i])::BIGINT),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS code
    FROM coded, crc),
after AS (
    SELECT c, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
    FROM drawn WHERE code <> 0),
placed AS (
    SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS kept,
           row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
    FROM after),
judged AS (
    SELECT c, i, turn, role, text, left(role, 1) AS f, CASE WHEN kept = '' THEN 'blank'
           WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
           WHEN right(kept, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           left(lag(role) OVER (PARTITION BY c ORDER BY i), 1) || left(role, 1) AS pair
    FROM placed),
counts AS (
    SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
           count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
           count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM judged GROUP BY c),
opened(a, b, cost, audit, added) AS (
    SELECT * FROM (VALUES ('', '', 0, '', []::VARCHAR[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
        ('', 'u', 3, 'I', ['user:']), ('s', 'u', 3, 'I', ['user:']), ('a', 'u', 3, 'I', ['user:']), ('u', 'a', 3, 'I', ['assistant:']),
        ('', 'a', 6, 'II', ['user:', 'assistant:']), ('s', 'a', 6, 'II', ['user:', 'assistant:']))),
follows(a, b) AS (SELECT * FROM (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u'))),
options AS (
    SELECT c, i, a, a AS b, 4 AS cost, 'D' AS audit, []::VARCHAR[] AS added FROM judged, (VALUES (''), ('s'), ('u'), ('a')) AS t(a)
    UNION ALL SELECT c, i, a, b, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [role || ':' || text]
    FROM judged JOIN follows ON b = f WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL SELECT c, i, a, b, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', [CASE b WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text]
    FROM judged JOIN follows ON b <> 's' WHERE fault NOT IN ('blank', 'duplicate')),
best(c, i, s, cost, audit, turns) AS (
    SELECT c, 0::BIGINT, '', 0, '', []::VARCHAR[] FROM counts
    UNION ALL
    SELECT p.c, e.i, e.b, p.cost + o.cost + e.cost AS cost, p.audit || o.audit || e.audit AS audit, p.turns || o.added || e.added
    FROM best p JOIN opened o ON o.a = p.s JOIN options e ON e.c = p.c AND e.i = p.i + 1 AND e.a = o.b
    QUALIFY row_number() OVER (PARTITION BY p.c, e.b ORDER BY p.cost + o.cost + e.cost, p.audit || o.audit || e.audit) = 1),
ended AS (
    SELECT p.c, p.cost + o.cost AS cost, p.audit || o.audit AS audit, array_to_string(p.turns || o.added, chr(10)) AS text
    FROM best p JOIN counts ON counts.c = p.c AND n = p.i JOIN opened o ON o.a = p.s AND o.b IN ('', 'a')
    QUALIFY row_number() OVER (PARTITION BY p.c ORDER BY p.cost + o.cost, p.audit || o.audit) = 1)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(text, '')) AS repaired_sha256
FROM ids LEFT JOIN counts USING (c) LEFT JOIN ended USING (c)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": _OP1, "op7_jaccard_join": _OP7, "op8_exact_top_k": _OP8, "op10_tool_calls": _OP10, "op11_hard_negatives": _OP11, "op12_conversation_repair": _OP12}
