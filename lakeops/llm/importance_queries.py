"""The registered resampling query and its SQL, in which a CRC is an exclusive-or over bytes by their distance to the end."""

from __future__ import annotations

from lakeops.llm.importance import resample
from lakeops.llm.registry import query, table

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

SQL = f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w, true AS source FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, {_WORDS}, false FROM benchmark
),
words AS (SELECT row, source, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
runs AS (
  SELECT row, source, word, lead(word) OVER o AS second, lead(word, 2) OVER o AS third
  FROM words WINDOW o AS (PARTITION BY row ORDER BY i)
),
features AS (
  SELECT row, source, word AS f FROM runs
  UNION ALL SELECT row, source, word || ' ' || second FROM runs WHERE second IS NOT NULL
  UNION ALL SELECT row, source, word || ' ' || second || ' ' || third FROM runs WHERE third IS NOT NULL
),
distinct_f AS (SELECT f, hex(encode(f)) AS h, strlen(f) AS n FROM features GROUP BY f),
steps AS (
  SELECT 0 AS step, b, b AS c FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b)
  UNION ALL
  SELECT step + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE step < 8
),
base AS (SELECT b, c FROM steps WHERE step = 8),
longest AS (SELECT max(n) AS n FROM distinct_f),
moved AS (
  SELECT 0 AS d, b, c FROM base
  UNION ALL
  SELECT d + 1, m.b, xor(m.c >> 8, t.c) FROM moved m JOIN base t ON t.b = m.c & 255 WHERE d < (SELECT n FROM longest)
),
starts AS (
  SELECT 0 AS n, CAST(4294967295 AS BIGINT) AS c
  UNION ALL
  SELECT n + 1, xor(s.c >> 8, t.c) FROM starts s JOIN base t ON t.b = s.c & 255 WHERE n < (SELECT n FROM longest)
),
bytes AS (
  SELECT f, n - 1 - i AS d, 16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1)
         + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 AS b
  FROM (SELECT f, h, n, unnest(range(n)) AS i FROM distinct_f)
),
crcs AS (
  SELECT d.f, xor(xor(any_value(s.c), bit_xor(m.c)), 4294967295) % 10000 AS bucket
  FROM distinct_f d JOIN bytes b ON b.f = d.f JOIN moved m ON m.d = b.d AND m.b = b.b JOIN starts s ON s.n = d.n
  GROUP BY d.f
),
placed AS (SELECT row, source, bucket FROM features JOIN crcs USING (f)),
counts AS (
  SELECT bucket, count(*) FILTER (source) AS s, count(*) FILTER (NOT source) AS t FROM placed GROUP BY bucket
),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE
         / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counts
),
sums AS (
  SELECT row, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket)
  WHERE source GROUP BY row
),
scored AS (
  SELECT t.row, doc_id, len(w) >= 20 AS fit, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(
           CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts t LEFT JOIN sums s ON s.row = t.row WHERE source
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id ASC NULLS LAST) AS place,
         count(*) FILTER (fit) OVER () * 5 // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= drawn THEN place END AS rank FROM ranked
"""


@query("op12_importance_resampling", SQL)
def op12_importance_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
