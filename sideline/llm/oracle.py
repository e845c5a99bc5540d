"""DuckDB SQL of the registered queries that SQL can express."""

_OP1 = r"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM e q JOIN e d ON d.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""

_OP3 = r"""
WITH d AS (SELECT doc_id, source IS NULL AS ns, coalesce(source, '') AS s, coalesce(md5(doc_id::VARCHAR), '') AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT ns, s, sum(size)::HUGEINT AS n FROM d GROUP BY ALL),
w AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY ns, s) - 1) % 3 + 1)::INT]::HUGEINT AS w FROM per),
c AS (SELECT *, coalesce(sum(3 * n) OVER o, 0)::HUGEINT AS held, coalesce(sum(w) OVER o, 0)::HUGEINT AS gone,
    (SELECT sum(n) FROM w)::HUGEINT AS total, (SELECT sum(w) FROM w)::HUGEINT AS allw
  FROM w WINDOW o AS (ORDER BY 3 * n::DOUBLE / w, ns, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, w * (total - held) > 3 * n * (allw - gone) AS capped FROM c),
ab AS (SELECT any_value(total) - coalesce(sum(3 * n) FILTER (WHERE capped), 0)::HUGEINT AS a, sum(w) FILTER (WHERE NOT capped)::HUGEINT AS b FROM f),
t AS (SELECT ns, s, n, CASE WHEN capped THEN (3 * n)::DOUBLE ELSE (w * a)::DOUBLE / b::DOUBLE END AS target,
    CASE WHEN capped THEN 3 * n ELSE (w * a) // b END AS want FROM f, ab),
r AS (SELECT *, sum(size) OVER (PARTITION BY ns, s ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM d JOIN t USING (ns, s))
SELECT doc_id, size, n::BIGINT AS source_size, target,
  (CASE WHEN n = 0 THEN 0 ELSE (want // n) * size + greatest(0, least(size, want % n - before)) END)::BIGINT AS taken FROM r"""

_OP4 = r"""
WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
c(node, label) AS (SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.b, c.label FROM c JOIN l ON l.a = c.node AND c.label < l.b),
m AS (SELECT node, min(label) AS component_id FROM c GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m ON node = vec_id LEFT JOIN n ON a = vec_id"""

_OP2 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
c(node, label) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, c.label FROM c JOIN l ON l.a = c.node AND c.label < l.b),
m AS (SELECT node, min(label) AS component_id FROM c GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM s JOIN m ON node = doc_id"""

_OP6 = r"""
WITH x AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
u AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM x),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM u),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, f.key IS NOT NULL AND doc_id <> last AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id"""

_OP7 = r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(coalesce(r, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
j AS (SELECT *, CASE
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j"""


_OP10 = r"""
WITH RECURSIVE t AS (SELECT conv_id::VARCHAR AS conv, turn, role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM conversations),
c AS (SELECT conv, conv || '-' || turn AS id, true AS called, (['search', 'fetch', 'sum'])[(n % 3 + 1)::INT] AS name, n, turn, md5(text) AS q,
    conv || '-' || (turn % 2 + 2 * ((turn - turn % 2) // 4)) AS need, turn % 2 + 2 * ((turn - turn % 2) // 4) < turn AS has
  FROM t WHERE role = 'user'),
a AS (SELECT conv || '-' || (turn - 1) AS id, md5(text) AS content FROM t WHERE role = 'assistant'),
r AS (SELECT id, min(content) AS content, count(*) - 1 AS more FROM a WHERE id IS NOT NULL GROUP BY id UNION ALL SELECT id, content, 0 FROM a WHERE id IS NULL),
l(id, level) AS (SELECT id, 0 FROM c WHERE NOT (has AND need IN (SELECT id FROM c)) UNION ALL SELECT c.id, l.level + 1 FROM c JOIN l ON c.need = l.id WHERE has),
j AS (SELECT conv, coalesce(c.id, r.id) AS id, name, level, coalesce(more, 0) AS repeats, content, has, need,
    CASE WHEN called IS NULL THEN 'no_call' WHEN c.id IS NULL THEN 'no_id' WHEN r.id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    CASE WHEN called IS NULL OR n % 13 = 0 THEN 'null' ELSE '{' || CASE WHEN n % 11 = 0 THEN '"exact":true,' ELSE '' END
      || CASE WHEN n % 7 <> 0 THEN '"limit":' || n || ',' ELSE '' END || '"query":"' || q || '","turn":' || turn || '}' END AS args,
    list_filter([CASE WHEN n % 13 = 0 THEN 'malformed arguments' END, CASE WHEN name = 'search' AND n % 13 <> 0 AND n % 7 = 0 THEN 'missing: limit' END,
      CASE WHEN name = 'fetch' AND n % 13 <> 0 AND n % 11 = 0 THEN 'not in schema: exact' END, CASE WHEN name = 'sum' THEN 'unknown tool' END,
      CASE WHEN name = 'fetch' AND n % 13 <> 0 THEN 'wrong type: turn' END], lambda x: x IS NOT NULL) AS problems
  FROM c FULL JOIN r ON c.id = r.id LEFT JOIN l ON l.id = c.id),
s AS (SELECT conv, id, name, status, level, repeats, problems, '{"arguments":' || args || ',"content":' || coalesce('"' || content || '"', 'null')
  || ',"conv":' || coalesce('"' || conv || '"', 'null') || ',"id":' || coalesce('"' || id || '"', 'null') || ',"level":' || coalesce(level::VARCHAR, 'null')
  || ',"name":' || coalesce('"' || name || '"', 'null') || ',"needs":[' || CASE WHEN has THEN '"' || need || '"' ELSE '' END
  || '],"problems":[' || coalesce(array_to_string(list_transform(problems, lambda x: '"' || x || '"'), ','), '') || '],"status":"' || status || '"}' AS json FROM j)
SELECT *, row_number() OVER (PARTITION BY conv ORDER BY level NULLS LAST, id NULLS LAST, json) AS position FROM s"""


#: CRC-32 of the bytes of a text, by a table made from the reversed polynomial
_CRC = r"""crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)"""


def _crc(text: str) -> str:
    """SQL of the unsigned CRC-32; crc_table must be joined."""
    byte = "strpos('123456789ABCDEF', substr(h, i, 1)) * 16 + strpos('123456789ABCDEF', substr(h, i + 1, 1))"
    return (
        f"xor(4294967295, list_reduce(list_transform([hex({text})], lambda h: list_transform(range(1, length(h), 2), lambda i: {byte}))[1],"
        " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))")


_OP11 = rf"""
WITH {_CRC},
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
v AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM w),
b AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM v),
k AS (SELECT g, {_crc("g")} % 10000 AS k FROM (SELECT g FROM g UNION SELECT g FROM b), crc_table),
s AS (SELECT k, count(*) AS s FROM g JOIN k USING (g) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN k USING (g) GROUP BY k),
f AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
  / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM (SELECT DISTINCT k FROM k) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
m AS (SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM g JOIN k USING (g) JOIN f USING (k) GROUP BY doc_id),
d AS (SELECT w.doc_id, len(w) AS n_words, len(w) + greatest(0, len(w) - 1) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(w.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN m ON m.doc_id = w.doc_id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM d WHERE n_words >= 20)
SELECT d.doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN rank <= 25 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank, n_words::BIGINT AS n_words
FROM d LEFT JOIN r ON r.doc_id = d.doc_id"""

#: The states of a conversation's roles: 0 none, 1 system, 2 asked, 3 answered. One row per turn and state,
#: first after inserts ahead of the turn, then after its own edit; of equal cost the least audit.
_OP13 = rf"""
WITH RECURSIVE {_CRC},
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate FROM conversations, crc_table),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
  CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE fate <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d),
x AS (SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank, substr(role, 1, 1) AS ini,
  count(*) OVER (PARTITION BY conv_id) AS n, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair FROM o),
y AS (SELECT *, NOT blank AND again AS dup, NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut FROM x),
ins AS (SELECT * FROM (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (1, 2, 'I'), (3, 2, 'I'), (2, 3, 'I'), (0, 3, 'II'), (1, 3, 'II')) v(a, b, e)),
ed AS (SELECT * FROM (VALUES (0, 's', 1, 'K', 0), (0, 'u', 2, 'K', 0), (1, 'u', 2, 'K', 0), (2, 'a', 3, 'K', 0), (3, 'u', 2, 'K', 0),
  (0, '', 0, 'K', 0), (1, '', 1, 'K', 0), (2, '', 2, 'K', 0), (3, '', 3, 'K', 0),
  (0, NULL, 2, 'R', 3), (1, NULL, 2, 'R', 3), (2, NULL, 3, 'R', 3), (3, NULL, 2, 'R', 3), (0, NULL, 0, 'D', 4), (1, NULL, 1, 'D', 4), (2, NULL, 2, 'D', 4), (3, NULL, 3, 'D', 4)) v(b, ini, c, e, cost)),
p(conv_id, i, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'said': NULL::VARCHAR}} FROM (SELECT DISTINCT conv_id FROM y)
  UNION ALL
  SELECT p.conv_id, y.i, ed.c, min({{'cost': p.best.cost + 3 * length(ins.e) + ed.cost + CASE WHEN y.cut AND ed.e <> 'D' THEN 3 ELSE 0 END, 'audit': p.best.audit || ins.e || ed.e,
    'said': nullif(concat_ws(chr(10), p.best.said,
      CASE ins.e WHEN 'I' THEN CASE WHEN ins.b = 3 THEN 'assistant:' ELSE 'user:' END WHEN 'II' THEN 'user:' || chr(10) || 'assistant:' END,
      CASE ed.e WHEN 'K' THEN y.role || ':' || y.text WHEN 'R' THEN CASE WHEN ed.c = 3 THEN 'assistant:' ELSE 'user:' END || y.text END), '')}})
  FROM p JOIN y ON y.conv_id IS NOT DISTINCT FROM p.conv_id AND y.i = p.i + 1 JOIN ins ON ins.a = p.state JOIN ed ON ed.b = ins.b AND (ed.ini IS NULL OR ed.ini = y.ini)
    AND (ed.e = 'D' OR NOT (y.blank OR y.dup)) GROUP BY p.conv_id, y.i, ed.c),
e AS (SELECT p.conv_id, min({{'cost': best.cost + CASE state WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END, 'audit': best.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'said': concat_ws(chr(10), best.said, CASE state WHEN 1 THEN 'user:' || chr(10) || 'assistant:' WHEN 2 THEN 'assistant:' END)}}) AS best
  FROM p JOIN (SELECT conv_id, count(*) AS n FROM y GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM p.conv_id AND z.n = p.i GROUP BY p.conv_id),
q AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE dup) AS duplicate,
  count(*) FILTER (WHERE cut) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM y GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost, coalesce(e.best.audit, '') AS audit, sha256(coalesce(e.best.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""


def build() -> dict[str, str]:
    return {
        "op1_exact_top_k": _OP1, "op2_ngram_jaccard_join": _OP2, "op3_mix_sources": _OP3,
        "op4_embedding_near_dedup": _OP4,
        "op6_line_dedup": _OP6, "op7_url_filter": _OP7, "op10_tool_call_linking": _OP10,
        "op11_importance_resampling": _OP11, "op13_conversation_repair": _OP13,
    }
