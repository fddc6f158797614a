"""The registered quality query."""

from __future__ import annotations

from lakeops.llm.quality import Rules, quality_report
from lakeops.llm.registry import query, table

RULES = Rules()

_CUTOFFS = ", ".join(map(str, RULES.cutoffs))

SQL = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM d
),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
windows AS (
  SELECT doc_id, i, word, lead(word) OVER o AS second, lead(word, 2) OVER o AS third
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, second, third) AS c FROM windows WHERE third IS NOT NULL
  ) WHERE c > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY doc_id
),
counts AS (
  SELECT w.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[ \t\n\x0B\f\r]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '!+', '', 'g')) AS marks,
         length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g')) AS capitals, len(lines) AS n_lines
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id
),
scored AS (
  SELECT *, n_words < {RULES.min_words} OR 100 * n_repeat_words > {RULES.max_repeat_pct} * n_words AS base_failed,
         greatest(least(1, coalesce(n_symbols / nullif(n_words, 0)::DOUBLE, 0)),
                  least(1, coalesce(marks / nullif(n_words, 0)::DOUBLE, 0)),
                  least(1, coalesce(capitals / nullif(word_chars, 0)::DOUBLE, 0)),
                  least(1, coalesce(n_dup_lines / nullif(n_lines, 0)::DOUBLE, 0)) / 2)::DOUBLE AS badness
  FROM counts
),
marked AS (
  SELECT s.lang, s.badness, l.good FROM scored s
  JOIN (SELECT doc_id, min(quality) = 1 AS good FROM labels GROUP BY doc_id) l ON l.doc_id = s.doc_id
  WHERE NOT base_failed AND l.good IS NOT NULL
),
tests AS (
  SELECT lang, c.cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND badness > c.cutoff) AS k,
         count(*) FILTER (NOT good) AS n_bad, count(*) FILTER (NOT good AND badness > c.cutoff) AS caught
  FROM marked, (SELECT unnest([{_CUTOFFS}])::DOUBLE AS cutoff) c GROUP BY lang, c.cutoff
),
passed AS (
  SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
           + i * ln({RULES.risk}) + (n - i) * ln(1 - {RULES.risk}))))
           <= {RULES.delta} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM marked)) AS ok,
         caught / nullif(n_bad, 0)::DOUBLE - k / nullif(n, 0)::DOUBLE AS gain
  FROM tests
),
chosen AS (
  SELECT lang, cutoff FROM (
    SELECT lang, cutoff, row_number() OVER (PARTITION BY lang ORDER BY gain DESC, cutoff DESC) AS r FROM (
      SELECT *, min(ok::INTEGER) OVER (PARTITION BY lang ORDER BY cutoff DESC) = 1 AS certified FROM passed
    ) WHERE certified AND gain > 0
  ) WHERE r = 1
)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (c.cutoff IS NULL OR badness <= c.cutoff) AS kept, badness
FROM scored s LEFT JOIN chosen c ON c.lang IS NOT DISTINCT FROM s.lang
"""


@query("op8_quality_rules", SQL)
def op8_quality_rules(spark, sf_dir):
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), RULES)
