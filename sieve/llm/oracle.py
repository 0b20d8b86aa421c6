"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS ord
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, (CASE i WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS w, (CASE i WHEN 0 THEN -0.5 WHEN 1 THEN 0 ELSE 0.5 END)::DOUBLE AS tilt
  FROM (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 AS i FROM per_source)),
-- levels: with the sources of smaller ratio at their limit, the rest share what is left by weight
levels AS (
  SELECT a.source, a.source_size, a.w, a.tilt, 2.0::DOUBLE * a.source_size / a.w AS ratio,
         ((SELECT 1.5::DOUBLE * sum(source_size) FROM weighed)
           - coalesce((SELECT sum(2.0::DOUBLE * b.source_size) FROM weighed b WHERE 2.0::DOUBLE * b.source_size / b.w < 2.0::DOUBLE * a.source_size / a.w), 0))
         / (SELECT sum(b.w) FROM weighed b WHERE 2.0::DOUBLE * b.source_size / b.w >= 2.0::DOUBLE * a.source_size / a.w) AS level
  FROM weighed a),
water AS (SELECT arg_min(level, ratio) AS level FROM levels WHERE level <= ratio),
goals AS (
  SELECT l.source, l.source_size, l.w, l.tilt,
         CASE WHEN w.level IS NULL THEN 2.0 * l.source_size ELSE least(2.0 * l.source_size, w.level * l.w) END AS target
  FROM levels l LEFT JOIN water w ON true),
placed AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.w, g.tilt, round(g.target)::BIGINT AS goal,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS pos
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
taken AS (
  SELECT *, greatest(0, least(size, goal - pos)) AS first_pass, greatest(0, least(size, goal - pos - source_size)) AS second_pass FROM placed),
shares AS (
  SELECT *, CASE WHEN first_pass > 0 THEN least((pos + first_pass / 2) / goal, 1.0) END AS u FROM taken)
SELECT doc_id, size, source_size, round(target, 6) AS target, (first_pass + second_pass)::BIGINT AS taken,
       ((first_pass > 0)::INT + (second_pass > 0)::INT) AS passes,
       round(CASE WHEN u IS NOT NULL THEN least(1.0, 2 * u * w / (w * (1 - tilt) + sqrt(w * (1 - tilt) * w * (1 - tilt) + 4 * w * tilt * u * w))) END, 6) AS position
FROM shares
"""

OP1 = r"""
WITH calls AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id, min(text) AS text, count(*) AS n
  FROM conversations WHERE role = 'user' GROUP BY conv_id, turn),
results AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || (turn - 1) AS call_id, min(text) AS content, count(*) AS n
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, 0 AS level,
       coalesce(c.turn, r.turn) AS position,
       CASE WHEN c.call_id IS NULL THEN 'orphan_result' WHEN r.call_id IS NULL THEN 'missing_result' ELSE 'linked' END AS status,
       true AS valid, '' AS errors, coalesce(c.n, 0)::INT AS n_calls, coalesce(r.n, 0)::INT AS n_results,
       '{"arguments":' || CASE WHEN c.call_id IS NULL THEN 'null' ELSE '{"chars":' || length(c.text) || ',"text":' || to_json(c.text) || ',"turn":' || c.turn || '}' END
         || ',"id":"' || coalesce(c.call_id, r.call_id) || '","name":' || CASE WHEN c.call_id IS NULL THEN 'null' ELSE '"reply"' END
         || ',"result":' || coalesce(to_json(r.content)::VARCHAR, 'null') || '}' AS canonical
FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
"""

OP6 = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
terms AS (SELECT vec_id, unnest(v) AS w, generate_subscripts(v, 1) AS t FROM good),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.w * c.w)::BIGINT AS score
  FROM terms q JOIN terms c ON q.t = c.t AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# h is crc32 of the decimal id, byte by byte and bit by bit, modulo 6; (depth, smallest member) names a node
OP13 = r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda s, x: list_reduce(list_concat([xor(s, x)], [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]),
             lambda p, q: CASE WHEN p % 2 = 1 THEN xor(p // 2, 3988292384::BIGINT) ELSE p // 2 END)), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns)),
parts AS (
  SELECT v.c, 0 AS own, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.pos <= v.h
  UNION ALL
  SELECT v.c, 1, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h),
rebuilt AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d FROM parts),
seqs AS (SELECT v.c, coalesce(list({'r': r.role, 't': r.text} ORDER BY r.d) FILTER (WHERE r.d IS NOT NULL), []) AS turns
  FROM convs v LEFT JOIN rebuilt r ON r.c = v.c GROUP BY v.c),
steps AS (SELECT c, len(turns) AS n, d, turns[1:d] AS prefix, CASE WHEN d > 0 THEN length(turns[d].t) ELSE 0 END AS size
  FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM seqs)),
placed AS (SELECT c, n, d, size, min(c) OVER (PARTITION BY d, prefix) AS node FROM steps),
nodes AS (
  SELECT node, d, count(*) AS n_convs, max(size) AS size,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM placed GROUP BY node, d),
parents AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN placed p ON p.c = n.node AND p.d = n.d - 1),
children AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM parents WHERE d > 0 GROUP BY ALL),
whole AS (SELECT p.*, coalesce(k.n_children, 0) AS n_children FROM parents p LEFT JOIN children k ON k.parent = p.node AND k.d = p.d),
sums AS (
  SELECT a.node, a.d, sum((w.n_convs - 1) * w.size)::BIGINT AS saved_tokens, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves
  FROM whole w JOIN placed a ON a.c = w.node AND a.d <= w.d GROUP BY ALL)
SELECT w.node AS conv_id, w.d AS depth, w.parent AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM whole w JOIN sums s ON s.node = w.node AND s.d = w.d
"""

ORACLE: dict[str, str] = {"op1_tool_calls": OP1, "op3_curriculum_mix": OP3, "op6_topk_search": OP6, "op13_prefix_trie": OP13}
