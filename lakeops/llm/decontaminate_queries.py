"""The registered decontamination query."""

from __future__ import annotations

from lakeops.llm.decontaminate import WINDOW, contamination_report
from lakeops.llm.registry import query, table

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

SQL = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS size, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS i FROM item_words WHERE len(w) > 0)
),
texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
grams AS (
  SELECT doc_id, i, s.size, string_agg(word, ' ') OVER (PARTITION BY doc_id, s.size ORDER BY i
         ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS win, word
  FROM words, (SELECT {WINDOW} AS size) s
),
short AS (
  SELECT b.doc_id, b.i, b.size, string_agg(a.word, ' ' ORDER BY a.i) AS win
  FROM (SELECT doc_id, i, size, w1 FROM words JOIN (
          SELECT DISTINCT size, string_split(win, ' ')[1] AS w1 FROM windows WHERE size < {WINDOW}) f ON f.w1 = word) b
  JOIN words a ON a.doc_id = b.doc_id AND a.i BETWEEN b.i AND b.i + b.size - 1
  GROUP BY b.doc_id, b.i, b.size, b.w1
),
hits AS (
  SELECT g.doc_id, g.i, g.size, w.item
  FROM (SELECT doc_id, i, size, win FROM grams UNION ALL SELECT * FROM short) g
  JOIN windows w ON w.size = g.size AND w.win = g.win
),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AS contaminated
FROM texts t LEFT JOIN covered c ON c.doc_id = t.doc_id LEFT JOIN items m ON m.doc_id = t.doc_id
"""


@query("op3_benchmark_decontamination", SQL)
def op3_benchmark_decontamination(spark, sf_dir):
    report = contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)
    return report.drop("spans")
