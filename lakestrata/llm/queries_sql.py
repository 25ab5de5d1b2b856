"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op13_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
repeated AS (
  SELECT line_key, min(doc_id) AS least FROM keyed WHERE length(line_key) >= 10
  GROUP BY line_key HAVING count(DISTINCT doc_id) > 1),
decided AS (
  SELECT k.*, coalesce(k.doc_id <> r.least, false) AS dropped FROM keyed k LEFT JOIN repeated r ON k.line_key = r.line_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM decided GROUP BY doc_id"""

SQL["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                                    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS shingles
  FROM words),
members AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.shingles"""

# floor(256 * x) of every component, without rows that take no part
_VECTORS = """
vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)"""

SQL["op5_topk_search"] = f"""
WITH {_VECTORS},
scores AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_dot_product(q.v, p.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors p ON q.vec_id <> p.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5"""

SQL["op11_hard_negatives"] = f"""
WITH {_VECTORS},
scores AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0 AND a.label IS NOT NULL AND b.label IS NOT NULL),
positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id
WHERE NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5"""
