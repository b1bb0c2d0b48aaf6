"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP10 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
     g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g USING (body)
"""

OP8 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
     l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
     k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON k.key = hot.key GROUP BY k.doc_id
"""

OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 5
        THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), chr(1))))
        WHEN len(ws) > 0 THEN [array_to_string(ws, chr(1))] ELSE [] END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS c
          FROM e a JOIN e b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (n - c) UNION ALL SELECT b, a FROM pairs WHERE 100 * c >= 75 * (n - c)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM s UNION SELECT reach.d, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT s.doc_id, any_value(len(sh)) AS n_shingles, min(r) AS component_id FROM s JOIN reach ON s.doc_id = reach.d GROUP BY s.doc_id
"""

OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents WHERE text IS NOT NULL),
     c AS (SELECT row_id, doc_id, len(ws) AS n, ws FROM d WHERE len(ws) > 0),
     total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM c),
     tf AS (SELECT row_id, any_value(doc_id) AS doc_id, any_value(n)::BIGINT AS n, term, count(*)::BIGINT AS tf
            FROM (SELECT row_id, doc_id, n, unnest(ws) AS term FROM c) GROUP BY row_id, term),
     w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, total GROUP BY term),
     i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL),
     s AS (SELECT item_id, row_id, any_value(doc_id) AS doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
           FROM i JOIN tf USING (term) JOIN w USING (term), total GROUP BY item_id, row_id),
     r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
           FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""

ORACLE = {"op11_lexical_search": OP11, "op3_jaccard_join": OP3, "op8_line_runs": OP8, "op10_digest_index": OP10}
