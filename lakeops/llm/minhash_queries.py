"""The registered near-duplicate query."""

from __future__ import annotations

from lakeops.llm.minhash import duplicate_report
from lakeops.llm.registry import query, table

SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
grams AS (
  SELECT doc_id, n, i, hash(string_agg(word, ' ') OVER o) AS h
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
),
shingles AS (SELECT DISTINCT doc_id, h FROM grams WHERE i <= greatest(1, n - 4)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id
  GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS start, a AS doc FROM (SELECT DISTINCT a FROM ends)
  UNION
  SELECT r.start, e.b FROM reached r JOIN ends e ON e.a = r.doc
),
least_of AS (SELECT start, min(doc) AS component FROM reached GROUP BY start)
SELECT t.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(l.component, t.doc_id) AS component_id,
       coalesce(l.component, t.doc_id) = t.doc_id AS kept
FROM texts t LEFT JOIN sizes s ON s.doc_id = t.doc_id LEFT JOIN least_of l ON l.start = t.doc_id
"""


@query("op6_minmax_dedup", SQL)
def op6_minmax_dedup(spark, sf_dir):
    return duplicate_report(table(spark, sf_dir, "documents"))
