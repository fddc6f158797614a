"""The registered URL filter query."""

from __future__ import annotations

from lakeops.llm.glob_filter import Rule, judge_urls, site_rule
from lakeops.llm.registry import query, table

RULES = (
    site_rule("block", "net/"),
    site_rule("allow", "example.net/en/"),
    site_rule("block", "example.com/de/"),
    site_rule("allow", "org/fr/"),
)

#: Kinds of sites that are blocked where no rule fits: any host with such a label, and session pages below any folder.
GLOBS = ("*.casino-**", "*.free-bet?.**", "*.cheap-pill?.**", "**/*/session*.html")
RULES += tuple(Rule(None, glob, "block", -1 - place) for place, glob in enumerate(GLOBS))

SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
),
rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')
),
fits AS (
  SELECT s.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC) AS place
  FROM split s JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
)
SELECT s.page_id, s.host, s.path, f.rule,
       coalesce(f.verdict, CASE WHEN regexp_matches('.' || s.host || s.path,
         '(?s)^([^/]*\.casino-.*|[^/]*\.free-bet[\x00-\x7F]\..*|[^/]*\.cheap-pill[\x00-\x7F]\..*|.*/[^/]*/session[^/]*\.html)$')
         THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN fits f ON f.page_id = s.page_id AND f.place = 1
"""


@query("op10_url_globs", SQL)
def op10_url_globs(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), RULES)
