"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLES = {
    "op5_warc_transactions": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hexes FROM p),
h AS (SELECT *, max(page_id) OVER (PARTITION BY hexes) AS holder FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}',
           1 + (((('0x' || substr(hexes, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to,
       true AS complete
FROM h
""",
    "op6_group_jaccard": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
f AS (SELECT x FROM t GROUP BY x HAVING count(*) > 1),
u AS (SELECT t.* FROM t JOIN f USING (x)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
      FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id WHERE r.c < e.b)
SELECT s.doc_id, len(sh) AS n_shingles, m.c AS component_id FROM s JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = s.doc_id
""",
    "op7_wu_manber": f"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
ip AS (SELECT item_id, least(len(ws), 10) AS k, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i, ws FROM iw WHERE len(ws) > 0),
pat AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS win FROM ip),
ks AS (SELECT DISTINCT k FROM pat),
dp AS (SELECT doc_id, k, unnest(range(1, len(ws) - k + 2)) AS i, ws FROM dw, ks WHERE len(ws) >= k),
occ AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS win FROM dp),
hit AS (SELECT o.doc_id, o.k, o.i, p.item_id FROM occ o JOIN pat p USING (k, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op11_collocations": f"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, row_number() OVER () AS d, {_LOWER} AS t FROM documents),
p AS (SELECT d, lang, unnest(regexp_extract_all(t, '[^.,;:!?\\x0A-\\x0D]+')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 10),
x AS (SELECT c.*, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp FROM c, (VALUES (1), (2)) AS s(j) WHERE j < k),
y AS (SELECT x.*, l.a AS l, r.a AS r, ((1000000::HUGEINT * x.a * x.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = lp AND l.k = j JOIN f r ON r.lang = x.lang AND r.phrase = rp AND r.k = x.k - j),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, j) = 1),
m AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, array_to_string(ws[1:2], ' ') AS phrase FROM c WHERE k = 3
      UNION ALL SELECT lang, a, array_to_string(ws[2:3], ' ') FROM c WHERE k = 3) GROUP BY ALL),
s AS (SELECT z.* FROM z LEFT JOIN m ON k = 2 AND m.lang = z.lang AND m.phrase = z.phrase WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s JOIN n USING (lang) QUALIFY rank <= 2000
""",
}
