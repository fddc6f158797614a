"""The registered filter audit and its SQL, which walks all orders step by step."""

from __future__ import annotations

from lakeops.llm.filter_audit import interaction_audit
from lakeops.llm.registry import query, table

SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
         min(doc_id) OVER (PARTITION BY t) AS first_id
  FROM d
),
marks AS (
  SELECT doc_id, coalesce(max(quality), 0) = 1 AS good, coalesce(max(toxic), 0) = 1 AS toxic FROM labels GROUP BY doc_id
),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN first_id IS NOT NULL AND coalesce(w.doc_id > first_id, true) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN marks m ON m.doc_id = w.doc_id
),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM masks GROUP BY ALL
),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
orders AS (
  SELECT '' AS o, 0 AS bits, 0 AS n UNION ALL
  SELECT o || letter, bits | bit, n + 1 FROM orders JOIN letters ON bits & bit = 0 WHERE n < 5
),
steps AS (
  SELECT o, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders WHERE n = 5
),
told AS (
  SELECT o, step, letter, bit,
         (SELECT coalesce(sum(b.bit), 0) FROM letters b WHERE instr(s.o, b.letter) < s.step) AS before
  FROM steps s JOIN letters l ON l.letter = substr(s.o, s.step, 1)
),
counted AS (
  SELECT part, o AS filter_order, step, letter,
         CAST(sum(CASE WHEN mask & (before::INTEGER | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN mask & before::INTEGER = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN mask & before::INTEGER <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN mask & before::INTEGER = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN mask & before::INTEGER = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM cells CROSS JOIN told GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""


@query("op13_filter_interactions", SQL)
def op13_filter_interactions(spark, sf_dir):
    return interaction_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
