"""Independent SQL (DuckDB dialect) for each registered query.

The views ``documents embeddings benchmark pages labels conversations`` are
registered by the checker.  The SQL repeats the *rules* (corpus view, token
patterns, FNV-1a, cover density, ...) relationally; it shares no code with
the Spark plans.
"""

from __future__ import annotations

NL = "chr(10)"

CORPUS = f"""corpus AS (
  SELECT doc_id,
    CASE WHEN strpos(coalesce(text, ''), {NL}) > 0
         THEN substr(coalesce(text, ''), 1, strpos(coalesce(text, ''), {NL}) - 1) ELSE '' END AS title,
    CASE WHEN strpos(coalesce(text, ''), {NL}) > 0
         THEN substr(coalesce(text, ''), strpos(coalesce(text, ''), {NL}) + 1) ELSE coalesce(text, '') END AS body,
    lang, source
  FROM documents)"""

FNV = ("list_reduce(string_split({g}, ''), lambda h, c: (xor(h, ascii(c)) * 16777619) & 4294967295, "
       "2166136261::BIGINT)")

BLANK_OK = "length(regexp_replace(coalesce({q}, ''), '^\\s+|\\s+$', '', 'g')) > 0"

DTOK = f"""dtok AS (
  SELECT doc_id AS id, regexp_extract_all(lower(title || {NL} || {NL} || body), '[a-z0-9]{{2,}}') AS t FROM corpus)"""

QUERIES_B = f"""qry AS (
  SELECT item_id AS query_id, coalesce(text, '') AS q, 20 AS k FROM benchmark
  WHERE {BLANK_OK.format(q='text')})"""

QTOK = """qtok AS (SELECT query_id AS id, regexp_extract_all(lower(q), '[a-z0-9]{2,}') AS t FROM qry)"""


def _sparse(tok: str, name: str) -> str:
    """Normalised sparse vectors (id, dim, v) from a token CTE."""
    return f"""{name}_g AS (
  SELECT id, unnest(t) AS g, 1.0 AS w FROM {tok}
  UNION ALL
  SELECT id, unnest(list_transform(range(1, len(t)), lambda i: 'bg:' || t[i] || '_' || t[i + 1])) AS g, 0.5 AS w
  FROM {tok}),
{name}_raw AS (
  SELECT id, ({FNV.format(g='g')}) % 128 AS dim, sum(w) AS v FROM {name}_g GROUP BY ALL),
{name} AS (
  SELECT id, dim, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS v FROM {name}_raw)"""


EMBED_TOKENS = f"""WITH {CORPUS}, {DTOK}
SELECT id AS doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct,
       array_to_string(t, ' ') AS tokens FROM dtok"""

HASH_BUCKETS = f"""WITH {CORPUS}, {DTOK},
voc AS (SELECT DISTINCT unnest(t) AS token FROM dtok)
SELECT token, {FNV.format(g='token')} AS hash, ({FNV.format(g='token')}) % 128 AS bucket FROM voc"""

EMBED_SPARSE = f"""WITH {CORPUS}, {DTOK}, {_sparse('dtok', 'dv')}
SELECT id AS doc_id, dim::INTEGER AS dim, round(v, 6) AS value FROM dv"""

COSINE_DOCS_CTE = f"""{CORPUS}, {DTOK}, {QUERIES_B}, {QTOK},
{_sparse('dtok', 'dv')},
{_sparse('qtok', 'qv')},
dot AS (SELECT qv.id AS query_id, dv.id AS doc_id, sum(qv.v * dv.v) AS s
        FROM qv JOIN dv ON qv.dim = dv.dim GROUP BY ALL),
pairs AS (SELECT q.query_id, c.doc_id, round(coalesce(d.s, 0.0), 6) + 0.0 AS score
          FROM qry q CROSS JOIN corpus c
          LEFT JOIN dot d ON d.query_id = q.query_id AND d.doc_id = c.doc_id),
ranked AS (SELECT query_id, doc_id, score,
                  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
           FROM pairs)"""

VECTOR_COSINE_DOCS = f"""WITH {COSINE_DOCS_CTE}
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20"""

QUERY_VECTOR_DIMS = f"""WITH {QUERIES_B}, {QTOK}, {_sparse('qtok', 'qv')},
r AS (SELECT id, dim, v, row_number() OVER (PARTITION BY id ORDER BY abs(v) DESC, dim) AS rank FROM qv)
SELECT id AS query_id, rank::INTEGER AS rank, dim::INTEGER AS dim, round(v, 6) AS value FROM r WHERE rank <= 5"""

EXPLAIN_VECTOR = f"""WITH {COSINE_DOCS_CTE},
qn AS (SELECT q.query_id, coalesce(sqrt(sum(v * v)), 0.0) AS n
       FROM qry q LEFT JOIN qv ON qv.id = q.query_id GROUP BY q.query_id)
SELECT r.query_id, r.rank::INTEGER AS rank, r.doc_id, round(1.0 - r.score, 6) AS cosine_distance,
       r.score AS cosine_similarity, round(qn.n, 6) AS query_norm
FROM ranked r JOIN qn USING (query_id) WHERE r.rank <= 20"""


def _emb_knn(metric: str) -> str:
    if metric == "cosine":
        val = ("CASE WHEN sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)) = 0 THEN 0.0 "
               "ELSE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * "
               "sqrt(list_dot_product(b.e, b.e))) END")
        order = "score DESC"
    elif metric == "l2":
        val = "sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"
        order = "score"
    else:
        val = "-list_dot_product(a.e, b.e)"
        order = "score"
    return f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, round({val}, 6) + 0.0 AS score
          FROM e a JOIN e b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, doc_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20"""


ORACLE = {
    "embed_tokens": EMBED_TOKENS,
    "hash_buckets": HASH_BUCKETS,
    "embed_sparse": EMBED_SPARSE,
    "embed_documents": EMBED_SPARSE,
    "vector_cosine_docs": VECTOR_COSINE_DOCS,
    "vector_cosine": _emb_knn("cosine"),
    "vector_l2": _emb_knn("l2"),
    "vector_ip": _emb_knn("ip"),
    "query_vector_dims": QUERY_VECTOR_DIMS,
    "explain_vector": EXPLAIN_VECTOR,
}


# -- text --------------------------------------------------------------------

WORD = "'[\\p{L}\\p{N}]+'"

POST = f"""pw AS (
  SELECT doc_id, regexp_extract_all(lower(title), {WORD}) AS tt, regexp_extract_all(lower(body), {WORD}) AS bt
  FROM corpus),
post AS (
  SELECT doc_id, term, pos::INTEGER AS pos, CASE WHEN pos <= nt THEN 'A' ELSE 'B' END AS weight,
         CASE WHEN pos <= nt THEN 1.0 ELSE 0.4 END AS w
  FROM (SELECT doc_id, len(tt) AS nt, unnest(tt || bt) AS term, unnest(range(1, len(tt || bt) + 1)) AS pos FROM pw))"""

TQ = f"""bq AS (SELECT item_id, replace(coalesce(text, ''), '"', ' ') AS t FROM benchmark),
tq AS (
  SELECT b.item_id * 4 + s.shape AS query_id,
         CASE s.shape WHEN 0 THEN b.t WHEN 1 THEN '"' || b.t || '"'
                      WHEN 2 THEN b.t || ' or ' || coalesce(n.t, '')
                      ELSE b.t || ' -"' || coalesce(n.t, '') || '"' END AS q
  FROM bq b LEFT JOIN (SELECT item_id - 1 AS item_id, t FROM bq) n USING (item_id)
  CROSS JOIN (VALUES (0), (1), (2), (3)) s(shape)),
qry_t AS (SELECT * FROM tq WHERE {BLANK_OK.format(q='q')})"""


def _qt(src: str) -> str:
    return f"""chunks AS (
  SELECT query_id, unnest(ch) AS chunk, unnest(range(0, len(ch))) AS item_id
  FROM (SELECT query_id, regexp_extract_all(q, '-?"[^"]*"?|[^\\s"]+') AS ch FROM {src})),
named AS (
  SELECT *, lower(chunk) = 'or' AS named,
         sum(CASE WHEN lower(chunk) = 'or' THEN 0 ELSE 1 END) OVER (PARTITION BY query_id ORDER BY item_id ROWS UNBOUNDED PRECEDING) AS run,
         max(item_id) OVER (PARTITION BY query_id) AS last_item
  FROM chunks),
ors AS (
  SELECT *, named AND item_id < last_item
         AND (row_number() OVER (PARTITION BY query_id, run, named ORDER BY item_id) - (run = 0)::INT) % 2 = 1 AS is_or
  FROM named),
cl AS (
  SELECT *, sum(is_or::INT) OVER (PARTITION BY query_id ORDER BY item_id ROWS UNBOUNDED PRECEDING) AS clause_id
  FROM ors),
items AS (
  SELECT query_id, clause_id, item_id, starts_with(chunk, '-') AS negated,
         regexp_extract_all(lower(regexp_replace(chunk, '^-|"', '', 'g')), {WORD}) AS words
  FROM cl WHERE NOT is_or),
qt AS (
  SELECT query_id, clause_id::INTEGER AS clause_id, item_id::INTEGER AS item_id, negated,
         len(words)::INTEGER AS n_words, unnest(words) AS term, unnest(range(0, len(words)))::INTEGER AS "offset"
  FROM items)"""


def _qt_plain(src: str) -> str:
    return f"""qt AS (
  SELECT query_id, 0 AS clause_id, unnest(range(0, len(ws)))::INTEGER AS item_id, false AS negated,
         1 AS n_words, unnest(ws) AS term, 0 AS "offset"
  FROM (SELECT query_id, regexp_extract_all(lower(q), {WORD}) AS ws FROM {src}))"""


MATCH = """hits AS (SELECT qt.*, p.doc_id, p.pos, p.w FROM qt JOIN post p ON p.term = qt.term),
occ AS (
  SELECT query_id, clause_id, item_id, negated, doc_id, pos - "offset" AS start, max("offset") AS mo
  FROM hits GROUP BY query_id, clause_id, item_id, negated, doc_id, pos - "offset", n_words
  HAVING count(*) = n_words),
npos AS (SELECT query_id, clause_id, count(DISTINCT item_id) AS n_pos FROM qt WHERE NOT negated GROUP BY ALL),
posok AS (
  SELECT o.query_id, o.clause_id, o.doc_id FROM occ o JOIN npos n USING (query_id, clause_id)
  WHERE NOT o.negated GROUP BY o.query_id, o.clause_id, o.doc_id, n.n_pos
  HAVING count(DISTINCT o.item_id) = n.n_pos),
negocc AS (SELECT DISTINCT query_id, clause_id, doc_id FROM occ WHERE negated),
clause_ok AS (
  SELECT query_id, clause_id, doc_id FROM posok
  UNION ALL
  SELECT q.query_id, q.clause_id, c.doc_id
  FROM (SELECT query_id, clause_id FROM qt GROUP BY ALL HAVING bool_and(negated)) q CROSS JOIN corpus c),
matched AS (
  SELECT DISTINCT query_id, doc_id FROM clause_ok p
  WHERE NOT EXISTS (SELECT 1 FROM negocc n WHERE n.query_id = p.query_id AND n.clause_id = p.clause_id
                    AND n.doc_id = p.doc_id))"""

COVER = """H AS (
  SELECT query_id, doc_id, pos, w,
         row_number() OVER (PARTITION BY query_id, doc_id ORDER BY pos) AS idx,
         sum(1.0 / w) OVER (PARTITION BY query_id, doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cw
  FROM (SELECT DISTINCT h.query_id, h.doc_id, h.pos, h.w FROM hits h JOIN matched m USING (query_id, doc_id)
        WHERE NOT h.negated)),
oi AS (
  SELECT o.query_id, o.doc_id, o.clause_id, o.item_id, hs.idx AS s_idx, he.idx AS e_idx
  FROM occ o JOIN matched m USING (query_id, doc_id)
  JOIN H hs ON hs.query_id = o.query_id AND hs.doc_id = o.doc_id AND hs.pos = o.start
  JOIN H he ON he.query_id = o.query_id AND he.doc_id = o.doc_id AND he.pos = o.start + o.mo
  WHERE NOT o.negated),
ev AS (SELECT DISTINCT query_id, doc_id, e_idx FROM oi),
pitems AS (SELECT DISTINCT query_id, clause_id, item_id FROM qt WHERE NOT negated),
lst AS (
  SELECT ev.query_id, ev.doc_id, ev.e_idx, it.clause_id, it.item_id, max(oi.s_idx) AS last
  FROM ev JOIN pitems it USING (query_id)
  LEFT JOIN oi ON oi.query_id = ev.query_id AND oi.doc_id = ev.doc_id AND oi.clause_id = it.clause_id
              AND oi.item_id = it.item_id AND oi.e_idx <= ev.e_idx
  GROUP BY ALL),
cv AS (SELECT query_id, doc_id, e_idx, clause_id, min(last) AS m FROM lst GROUP BY ALL
       HAVING count(last) = count(*)),
pe AS (SELECT query_id, doc_id, e_idx, max(m) AS p FROM cv GROUP BY ALL),
cov AS (
  SELECT * FROM (SELECT *, max(p) OVER (PARTITION BY query_id, doc_id ORDER BY e_idx
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM pe)
  WHERE prev IS NULL OR p > prev),
sc AS (
  SELECT c.query_id, c.doc_id,
         sum((c.e_idx - c.p + 1) / (he.cw - hs.cw + 1.0 / hs.w)
             / (1 + CASE WHEN (he.pos - hs.pos) - (c.e_idx - c.p) < 0 THEN floor((c.e_idx - c.p) / 2)
                         ELSE (he.pos - hs.pos) - (c.e_idx - c.p) END)) AS score
  FROM cov c
  JOIN H hs ON hs.query_id = c.query_id AND hs.doc_id = c.doc_id AND hs.idx = c.p
  JOIN H he ON he.query_id = c.query_id AND he.doc_id = c.doc_id AND he.idx = c.e_idx
  GROUP BY ALL),
tranked AS (
  SELECT query_id, doc_id, round(coalesce(score, 0.0), 6) + 0.0 AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(coalesce(score, 0.0), 6) DESC, doc_id) AS rank
  FROM matched LEFT JOIN sc USING (query_id, doc_id))"""

TOKENS_SIMPLE = f"""WITH {CORPUS}, {POST.split(',' + chr(10) + 'post AS')[0]}
SELECT doc_id, len(tt || bt) AS n_words, len(list_distinct(tt || bt)) AS n_lexemes,
       array_to_string(list_sort(list_distinct(tt || bt)), ' ') AS lexemes FROM pw"""

WEIGHTED_POSTINGS = f"""WITH {CORPUS}, {POST}
SELECT doc_id, term, pos, weight FROM post"""

TERM_STATS = f"""WITH {CORPUS}, {POST}
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM post GROUP BY term"""

QUERY_TERMS = f"""WITH {TQ}, {_qt('qry_t')}
SELECT query_id, clause_id, item_id, negated, "offset", term, n_words FROM qt"""

SEARCH_MATCH = f"""WITH {CORPUS}, {POST}, {TQ}, {_qt('qry_t')}, {MATCH}
SELECT query_id, doc_id FROM matched"""

SEARCH_RANKED = f"""WITH {CORPUS}, {POST}, {TQ}, {_qt('qry_t')}, {MATCH}, {COVER}
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM tranked WHERE rank <= 20"""

SEARCH_PLAIN = f"""WITH {CORPUS}, {POST}, {QUERIES_B}, {_qt_plain('qry')}, {MATCH}, {COVER}
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM tranked WHERE rank <= 20"""

SEARCH_PHRASE = f"""WITH {CORPUS}, {POST}, {QUERIES_B},
qph AS (SELECT query_id, '"' || replace(q, '"', ' ') || '"' AS q FROM qry), {_qt('qph')}, {MATCH}
SELECT query_id, doc_id FROM matched"""

BLANK_QUERIES = f"""SELECT item_id * 2 AS query_id, NOT ({BLANK_OK.format(q='text')}) AS blank FROM benchmark
UNION ALL
SELECT item_id * 2 + 1, NOT ({BLANK_OK.format(q="regexp_replace(coalesce(text, ''), '\\S', '', 'g')")})
FROM benchmark"""

EXPLAIN_TEXT = f"""WITH {CORPUS}, {POST}, {TQ}, {_qt('qry_t')}, {MATCH}, {COVER},
top AS (SELECT * FROM tranked WHERE rank <= 20),
ql AS (SELECT query_id, list_sort(list_distinct(list(term))) AS qlex FROM qt GROUP BY query_id),
dl AS (SELECT doc_id, list_sort(list_distinct(tt || bt)) AS lex FROM pw
       WHERE doc_id IN (SELECT doc_id FROM top)),
w1 AS (SELECT query_id, clause_id, item_id, negated, "offset", term,
              lag("offset") OVER (PARTITION BY query_id, clause_id, item_id ORDER BY "offset") AS prev FROM qt),
it AS (
  SELECT query_id, clause_id, item_id, negated, count(*) AS n,
         string_agg(CASE WHEN prev IS NULL THEN '' WHEN "offset" - prev = 1 THEN ' <-> '
                         ELSE ' <' || ("offset" - prev)::VARCHAR || '> ' END || '''' || term || '''', ''
                    ORDER BY "offset") AS txt
  FROM w1 GROUP BY ALL),
it2 AS (SELECT query_id, clause_id, item_id,
               CASE WHEN negated THEN '!' ELSE '' END ||
               CASE WHEN n > 1 AND negated THEN '( ' || txt || ' )' ELSE txt END AS txt FROM it),
cl2 AS (SELECT query_id, clause_id, string_agg(txt, ' & ' ORDER BY item_id) AS txt FROM it2 GROUP BY ALL),
pq AS (SELECT query_id, string_agg(txt, ' | ' ORDER BY clause_id) AS parsed_query FROM cl2 GROUP BY ALL)
SELECT t.query_id, t.rank::INTEGER AS rank, t.doc_id, t.score, pq.parsed_query,
       array_to_string(list_sort(list_intersect(dl.lex, ql.qlex)), ' ') AS matched_lexemes,
       substr(array_to_string(list_transform(dl.lex, lambda x: '''' || x || ''''), ' '), 1, 280) AS tsvector_preview
FROM top t JOIN ql USING (query_id) JOIN pq USING (query_id) JOIN dl USING (doc_id)"""

ORACLE.update({
    "tokens_simple": TOKENS_SIMPLE,
    "weighted_postings": WEIGHTED_POSTINGS,
    "term_stats": TERM_STATS,
    "query_terms": QUERY_TERMS,
    "search_match": SEARCH_MATCH,
    "search_ranked": SEARCH_RANKED,
    "search_plain": SEARCH_PLAIN,
    "search_phrase": SEARCH_PHRASE,
    "blank_queries": BLANK_QUERIES,
    "explain_text": EXPLAIN_TEXT,
})


# -- hybrid ------------------------------------------------------------------

BOTH = f"""{COSINE_DOCS_CTE}, {POST}, {_qt('qry')}, {MATCH}, {COVER},
tl AS (SELECT query_id, doc_id, score, rank FROM tranked WHERE rank <= 20),
vl AS (SELECT query_id, doc_id, score, rank FROM ranked WHERE rank <= 20),
tn AS (SELECT *, CASE WHEN max(score) OVER w - min(score) OVER w = 0 THEN 1.0
                      ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS norm
       FROM tl WINDOW w AS (PARTITION BY query_id)),
vn AS (SELECT *, CASE WHEN max(score) OVER w - min(score) OVER w = 0 THEN 1.0
                      ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS norm
       FROM vl WINDOW w AS (PARTITION BY query_id)),
mg AS (SELECT coalesce(t.query_id, v.query_id) AS query_id, coalesce(t.doc_id, v.doc_id) AS doc_id,
              t.score AS text_raw, t.norm AS text_norm, v.score AS vector_raw, v.norm AS vector_norm,
              t.rank AS trank, v.rank AS vrank,
              round(0.5 * coalesce(t.norm, 0.0) + 0.5 * coalesce(v.norm, 0.0), 6) + 0.0 AS blended
       FROM tn t FULL OUTER JOIN vn v ON t.query_id = v.query_id AND t.doc_id = v.doc_id),
hr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY blended DESC,
                                    CASE WHEN trank IS NULL THEN 1 ELSE 0 END, coalesce(trank, vrank)) AS hrank
       FROM mg)"""

MINMAX_SCORES = f"""WITH {BOTH}
SELECT query_id, 'text' AS engine, doc_id, score, round(norm, 6) AS norm FROM tn
UNION ALL
SELECT query_id, 'vector' AS engine, doc_id, score, round(norm, 6) AS norm FROM vn"""

HYBRID_BLEND = f"""WITH {BOTH}
SELECT query_id, hrank::INTEGER AS rank, doc_id, blended AS score FROM hr WHERE hrank <= 20"""

EXPLAIN_HYBRID = f"""WITH {BOTH}
SELECT query_id, hrank::INTEGER AS rank, doc_id, blended AS score, text_raw, round(text_norm, 6) AS text_norm,
       vector_raw, round(vector_norm, 6) AS vector_norm, 0.5 AS text_weight, 0.5 AS vector_weight
FROM hr WHERE hrank <= 20"""

HYBRID_RRF = f"""WITH {BOTH},
u AS (SELECT query_id, doc_id, rank FROM tl UNION ALL SELECT query_id, doc_id, rank FROM vl),
s AS (SELECT query_id, doc_id, round(sum(1.0 / (60 + rank)), 6) + 0.0 AS score FROM u GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20"""

ENGINE_OVERLAP = f"""WITH {BOTH},
hl AS (SELECT * FROM hr WHERE hrank <= 20),
nt AS (SELECT query_id, count(*) AS n FROM tl GROUP BY ALL),
nv AS (SELECT query_id, count(*) AS n FROM vl GROUP BY ALL),
nh AS (SELECT query_id, count(*) AS n FROM hl GROUP BY ALL),
bo AS (SELECT t.query_id, count(*) AS n, avg(abs(t.rank - v.rank)) AS d
       FROM tl t JOIN vl v ON t.query_id = v.query_id AND t.doc_id = v.doc_id GROUP BY ALL),
x AS (SELECT q.query_id, coalesce(nt.n, 0) AS n_text, coalesce(nv.n, 0) AS n_vector, coalesce(nh.n, 0) AS n_hybrid,
             coalesce(bo.n, 0) AS n_common, bo.d
      FROM qry q LEFT JOIN nt USING (query_id) LEFT JOIN nv USING (query_id) LEFT JOIN nh USING (query_id)
      LEFT JOIN bo USING (query_id))
SELECT query_id, n_text, n_vector, n_hybrid, n_common,
       CASE WHEN n_text + n_vector - n_common = 0 THEN 0.0
            ELSE round(n_common / (n_text + n_vector - n_common), 6) END AS jaccard,
       round(d, 6) AS mean_rank_diff FROM x"""

LIMIT = "CASE {id} % 6 WHEN 3 THEN 5 WHEN 4 THEN 25 WHEN 5 THEN 50 ELSE 20 END"

WORDS = f"""sw AS (
  SELECT word, row_number() OVER (ORDER BY word) AS id
  FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), {WORD})) AS word FROM benchmark))"""

WORD_SUMS = "ws AS (SELECT term, doc_id, sum(w) AS s FROM post WHERE term IN (SELECT word FROM sw) GROUP BY ALL)"

SEARCH_LIMITS = f"""WITH {CORPUS}, {POST}, {WORDS}, {WORD_SUMS},
r AS (SELECT sw.id AS query_id, ws.doc_id, round(s, 6) + 0.0 AS score,
             row_number() OVER (PARTITION BY sw.id ORDER BY round(s, 6) DESC, ws.doc_id) AS rank
      FROM sw JOIN ws ON ws.term = sw.word)
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {LIMIT.format(id='query_id')}"""

SEARCH_NEGATED = f"""WITH {CORPUS}, {POST}, {WORDS}, {WORD_SUMS},
pair AS (SELECT a.id, a.word AS w1, b.word AS w2 FROM sw a JOIN sw b ON b.id = a.id + 1),
m AS (SELECT id * 2 AS query_id, c.doc_id, 0.0 AS score FROM pair CROSS JOIN corpus c
      WHERE NOT EXISTS (SELECT 1 FROM ws WHERE ws.term = w1 AND ws.doc_id = c.doc_id)
      UNION ALL
      SELECT id * 2 + 1, c.doc_id, coalesce(p.s, 0.0) FROM pair CROSS JOIN corpus c
      LEFT JOIN ws p ON p.term = w1 AND p.doc_id = c.doc_id
      LEFT JOIN ws n ON n.term = w2 AND n.doc_id = c.doc_id
      WHERE p.s IS NOT NULL OR n.s IS NULL),
r AS (SELECT query_id, doc_id, round(score, 6) + 0.0 AS score,
             row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM m)
SELECT query_id, rank::INTEGER AS rank, doc_id, score::DOUBLE AS score FROM r WHERE rank <= {LIMIT.format(id='query_id')}"""

SEARCH_WORDS = f"""WITH {CORPUS}, {POST}, {WORDS}, {WORD_SUMS},
asked AS (
  SELECT id * 2 AS query_id, word FROM sw
  UNION ALL SELECT a.id * 2 + 1, unnest([a.word, b.word]) FROM sw a JOIN sw b ON b.id = a.id + 1),
m AS (SELECT query_id, doc_id, round(sum(s), 6) + 0.0 AS score FROM asked JOIN ws ON ws.term = asked.word GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM m)
SELECT query_id, rank::INTEGER AS rank, doc_id, score::DOUBLE AS score FROM r WHERE rank <= 20"""

VECTOR_LIMITS = f"""WITH {COSINE_DOCS_CTE}
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {LIMIT.format(id='query_id')}"""

HYBRID_LIMITS = HYBRID_RRF.replace("rank <= 20", f"rank <= {LIMIT.format(id='query_id')}")

ORACLE.update({
    "search_limits": SEARCH_LIMITS,
    "search_words": SEARCH_WORDS,
    "stored_search": SEARCH_RANKED,
    "stored_phrase": SEARCH_PHRASE,
    "stream_search": SEARCH_RANKED,
    "search_negated": SEARCH_NEGATED,
    "vector_limits": VECTOR_LIMITS,
    "hybrid_limits": HYBRID_LIMITS,
    "minmax_scores": MINMAX_SCORES,
    "hybrid_blend": HYBRID_BLEND,
    "explain_hybrid": EXPLAIN_HYBRID,
    "hybrid_rrf": HYBRID_RRF,
    "engine_overlap": ENGINE_OVERLAP,
})


# -- R4, R6, R7, X4-X6 -------------------------------------------------------

# White space of the reference's split: tab to carriage return, Unicode separators, U+FEFF.
BLANK = r"[\t\n\v\f\r\p{Z}\x{FEFF}]"

SEARCH_OVERLAP = f"""WITH {CORPUS}, {QUERIES_B},
terms AS (SELECT query_id, t AS term, count(*) AS n
          FROM (SELECT query_id, unnest(string_split_regex(lower(q), '{BLANK}+')) AS t FROM qry)
          WHERE length(t) > 0 GROUP BY ALL),
sc AS (SELECT t.query_id, c.doc_id,
              sum(t.n * CASE WHEN contains(lower(c.title || ' ' || c.body), t.term)
                             THEN CASE WHEN contains(lower(c.title), t.term) THEN 1.5 ELSE 1.0 END
                             ELSE 0.0 END) AS score
       FROM terms t CROSS JOIN corpus c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20"""


def _grams(src: str, idc: str, col: str, name: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT id, gram FROM (
    SELECT id, unnest(list_transform(range(1, length(p) - 1), lambda i: substr(p, i, 3))) AS gram
    FROM (SELECT {idc} AS id, '  ' || w || ' ' AS p
          FROM (SELECT {idc}, unnest(regexp_extract_all(lower(coalesce({col}, '')), {WORD})) AS w FROM {src}))))"""


FUZZY_CTE = f"""{CORPUS}, {QUERIES_B},
{_grams('qry', 'query_id', 'q', 'qg')},
{_grams('corpus', 'doc_id', 'title', 'dg')},
nq AS (SELECT id, count(*) AS n FROM qg GROUP BY id),
nd AS (SELECT id, count(*) AS n FROM dg GROUP BY id),
it AS (SELECT q.id AS query_id, d.id AS doc_id, count(*) AS inter FROM qg q JOIN dg d ON q.gram = d.gram GROUP BY ALL),
sim AS (SELECT it.query_id, it.doc_id, inter, nq.n + nd.n - inter AS either,
               round(inter / (nq.n + nd.n - inter), 6) + 0.0 AS similarity
        FROM it JOIN nq ON nq.id = it.query_id JOIN nd ON nd.id = it.doc_id)"""

FUZZY_TITLE = f"""WITH {FUZZY_CTE}
SELECT query_id, doc_id, similarity FROM sim WHERE inter * 1000 >= either * 300"""

FUZZY_TITLE_K = f"""WITH {FUZZY_CTE},
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS rank
      FROM sim WHERE inter * 1000 >= either * 100)
SELECT query_id, rank::INTEGER AS rank, doc_id, similarity FROM r WHERE rank <= {LIMIT.format(id='query_id')}"""

TITLE_ILIKE = f"""WITH {CORPUS},
w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), {WORD})) AS pattern FROM benchmark),
pat AS (SELECT row_number() OVER (ORDER BY pattern) AS query_id, pattern FROM w)
SELECT p.query_id, c.doc_id FROM pat p JOIN corpus c ON contains(lower(c.title), p.pattern)"""

LIMIT_RULE = """SELECT item_id AS query_id, ((item_id % 7) * 10 - 20)::INTEGER AS k_requested,
       (CASE WHEN (item_id % 7) * 10 - 20 > 0 THEN (item_id % 7) * 10 - 20 ELSE 20 END)::INTEGER AS k_used
FROM benchmark"""

SNIP = "CASE WHEN length({b}) > 220 THEN substr({b}, 1, 220) || '...' ELSE {b} END"

SNIPPETS = f"""WITH {CORPUS}
SELECT doc_id, {SNIP.format(b='body')} AS snippet FROM corpus"""

SHAPED_HITS = f"""WITH {COSINE_DOCS_CTE}
SELECT r.query_id, r.rank::INTEGER AS rank, r.doc_id, c.title, coalesce(c.lang, '') || ',' || coalesce(c.source, '') AS tags,
       {SNIP.format(b='c.body')} AS snippet, r.score
FROM ranked r JOIN corpus c USING (doc_id) WHERE r.rank <= 20"""

ORACLE.update({
    "search_overlap": SEARCH_OVERLAP,
    "fuzzy_title": FUZZY_TITLE,
    "fuzzy_title_k": FUZZY_TITLE_K,
    "title_ilike": TITLE_ILIKE,
    "limit_rule": LIMIT_RULE,
    "snippets": SNIPPETS,
    "shaped_hits": SHAPED_HITS,
})


# -- S1-S12 ------------------------------------------------------------------

JSONL_ROUNDTRIP = f"""WITH {CORPUS}
SELECT doc_id, title, body, coalesce(lang, '') || ',' || coalesce(source, '') AS tags FROM corpus"""

INDEX_SUMMARY = f"""WITH {CORPUS}, {POST}, {DTOK}, {_sparse('dtok', 'dv')},
ps AS (SELECT doc_id, count(*) AS n_postings, count(DISTINCT term) AS n_lexemes FROM post GROUP BY doc_id),
vs AS (SELECT id AS doc_id, count(*) AS n_dims FROM dv WHERE v <> 0 GROUP BY id)
SELECT c.doc_id, c.title, coalesce(ps.n_postings, 0) AS n_postings, coalesce(ps.n_lexemes, 0) AS n_lexemes,
       coalesce(vs.n_dims, 0)::INTEGER AS n_dims
FROM corpus c LEFT JOIN ps USING (doc_id) LEFT JOIN vs USING (doc_id)"""

ASSIGN_IDS = """SELECT row_number() OVER (ORDER BY lang, doc_id) AS id, doc_id FROM documents"""

PAGES_TITLE = "regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>(.*?)</title>', 1)"

UNION_SOURCES = f"""WITH {CORPUS},
u AS (SELECT 0 AS source_order, doc_id AS orig_id, title FROM corpus
      UNION ALL SELECT 1, page_id, {PAGES_TITLE} FROM pages)
SELECT row_number() OVER (ORDER BY source_order, orig_id) AS id, source_order, orig_id, title FROM u"""

LOOKUP_IDS = f"""WITH {CORPUS}
SELECT l.doc_id, c.title, c.title IS NOT NULL AS found
FROM (SELECT DISTINCT doc_id FROM labels) l LEFT JOIN corpus c USING (doc_id)"""

CORPUS_COUNT = "SELECT count(*) AS n FROM documents"

CLEAN_CORPUS = f"""WITH {CORPUS},
rec AS (SELECT doc_id, title, body, source AS category,
               CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS category_order, doc_id AS listing_order
        FROM corpus),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title
                                   ORDER BY category_order, listing_order, doc_id) AS f FROM rec) WHERE f = 1)
SELECT doc_id, title, lower(replace(category, '_', ' ')) AS tag, length(body) AS n_chars
FROM firsts WHERE body IS NOT NULL AND length(body) >= 120"""

ORACLE.update({
    "jsonl_roundtrip": JSONL_ROUNDTRIP,
    "index_documents": INDEX_SUMMARY,
    "stream_index": INDEX_SUMMARY,
    "assign_ids": ASSIGN_IDS,
    "union_sources": UNION_SOURCES,
    "lookup_ids": LOOKUP_IDS,
    "corpus_count": CORPUS_COUNT,
    "clean_corpus": CLEAN_CORPUS,
})

# V8 with nprobe = lists must equal exact search.
ORACLE["vector_ivf"] = VECTOR_COSINE_DOCS


# V8 / V9 with stored lists: 10 centroids far from each other, 3 probed.
def _lists_cte(lists: int, probed: int) -> str:
    steps = ["m0 AS MATERIALIZED (SELECT DISTINCT id, -2.0 AS near FROM dv)"]
    for i in range(lists):
        pick = "id" if i == 0 else "near, id"
        steps.append(f"c{i} AS MATERIALIZED (SELECT dv.dim, dv.v FROM dv JOIN (SELECT id FROM m{i} ORDER BY {pick} LIMIT 1) p USING (id))")
        steps.append(f"s{i} AS MATERIALIZED (SELECT dv.id, round(sum(dv.v * c.v), 6) + 0.0 AS s FROM dv JOIN c{i} c USING (dim) GROUP BY dv.id)")
        steps.append(f"t{i} AS (SELECT qv.id, round(sum(qv.v * c.v), 6) + 0.0 AS s FROM qv JOIN c{i} c USING (dim) GROUP BY qv.id)")
        steps.append(f"m{i + 1} AS MATERIALIZED (SELECT m.id, greatest(m.near, coalesce(s.s, 0.0)) AS near FROM m{i} m LEFT JOIN s{i} s USING (id))")
    docs = " UNION ALL ".join(f"SELECT c.doc_id, {i} AS list, coalesce(s.s, 0.0) AS s FROM corpus c LEFT JOIN s{i} s ON s.id = c.doc_id"
                              for i in range(lists))
    asks = " UNION ALL ".join(f"SELECT q.query_id, {i} AS list, coalesce(t.s, 0.0) AS s FROM qry q LEFT JOIN t{i} t ON t.id = q.query_id"
                              for i in range(lists))
    return ", ".join(steps) + f""",
home AS (SELECT doc_id, list FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, list) AS r FROM ({docs})) WHERE r = 1),
probe AS (SELECT query_id, list FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, list) AS r FROM ({asks})) WHERE r <= {probed}),
found AS (SELECT p.query_id, p.doc_id, p.score, row_number() OVER (PARTITION BY p.query_id ORDER BY p.score DESC, p.doc_id) AS rank
          FROM pairs p JOIN home h USING (doc_id) JOIN probe b ON b.query_id = p.query_id AND b.list = h.list)"""


LISTS_CTE = f"{COSINE_DOCS_CTE}, {_lists_cte(10, 3)}"

ORACLE["vector_lists"] = f"""WITH {LISTS_CTE}
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM found WHERE rank <= 20"""

ORACLE["list_recall"] = f"""WITH {LISTS_CTE},
best AS (SELECT query_id, doc_id FROM ranked WHERE rank <= 20),
near AS (SELECT query_id, doc_id FROM found WHERE rank <= 20)
SELECT b.query_id, count(*) AS n_exact, count(n.doc_id) AS n_common,
       round(count(n.doc_id) / least(count(*), 20), 6) AS recall
FROM best b LEFT JOIN near n ON n.query_id = b.query_id AND n.doc_id = b.doc_id GROUP BY b.query_id"""

# X2, X4 with whole documents and details.
TAGS = "concat_ws(',', c.lang, c.source)"

ORACLE["shaped_text"] = f"""WITH {CORPUS.replace('corpus AS', 'c AS', 1)}
SELECT h.query_id, h.rank, h.doc_id, c.title, c.body, {TAGS} AS tags, h.score
FROM ({SEARCH_RANKED}) h JOIN c USING (doc_id)"""

ORACLE["shaped_hybrid"] = f"""WITH {CORPUS.replace('corpus AS', 'c AS', 1)}
SELECT h.*, c.title, c.body, {TAGS} AS tags FROM ({EXPLAIN_HYBRID}) h JOIN c USING (doc_id)"""

ORACLE["explain_dims"] = f"""WITH x AS ({EXPLAIN_VECTOR}), d AS ({QUERY_VECTOR_DIMS}),
g AS (SELECT query_id, string_agg(dim || ':' || printf('%.6f', value), ' ' ORDER BY rank) AS top_dims FROM d GROUP BY query_id)
SELECT x.*, g.top_dims FROM x LEFT JOIN g USING (query_id)"""
