"""The registered WARC query."""

from __future__ import annotations

from lakeops.llm.registry import query, table
from lakeops.llm.warc_zip import archived

SQL = """
WITH d AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
e AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1)),
      'string_agg', '') AS payload_digest, max(page_id) OVER (PARTITION BY h) AS largest
  FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM e
"""


@query("op2_warc_zip", SQL)
def op2_warc_zip(spark, sf_dir):
    return archived(table(spark, sf_dir, "pages"))
