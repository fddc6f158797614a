"""Checks, rules, rejects and schema gates."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.plans import quality_checks, quality_rules, quality_service, schema_gate
from lakeops.queries.registry import query, table
from lakeops.session import work_dir

RESULT_COLUMNS = ("name", "passed", "bad", "total", "percent")


def _readings(spark, sf):
    """Events; those of type error have no value and purchases no user."""
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "purchase", F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        "props",
    )


READINGS_SQL = """
    WITH readings AS (
      SELECT event_id, CASE WHEN event_type <> 'purchase' THEN user_id END AS user_id, event_type,
             CASE WHEN event_type <> 'error' THEN value END AS value, props
      FROM events
    )
"""


def _results(df, checks):
    return quality_checks.check_results(df, checks).select(*RESULT_COLUMNS).withColumn(
        "percent", F.round("percent", 6)
    )


@query(
    "dq_null_pct",
    READINGS_SQL
    + """
    SELECT 'null_pct_value' AS name, 100.0 * count_if(value IS NULL) / count(*) <= 50 AS passed,
           CAST(count_if(value IS NULL) AS BIGINT) AS bad, count(*) AS total,
           round(CAST(count_if(value IS NULL) AS DOUBLE) / count(*) * 100, 6) AS percent FROM readings
    UNION ALL
    SELECT 'null_pct_user_id', 100.0 * count_if(user_id IS NULL) / count(*) <= 5,
           CAST(count_if(user_id IS NULL) AS BIGINT), count(*),
           round(CAST(count_if(user_id IS NULL) AS DOUBLE) / count(*) * 100, 6) FROM readings
    """,
)
def dq_null_pct(spark, sf):
    return _results(
        _readings(spark, sf),
        [
            {"type": "null_pct", "column": "value", "max_percent": 50},
            {"type": "null_pct", "column": "user_id", "max_percent": 5},
        ],
    )


@query(
    "dq_duplicates",
    """
    SELECT 'duplicate_check' AS name, n <= 0 AS passed, n AS bad, CAST(NULL AS BIGINT) AS total,
           CAST(NULL AS DOUBLE) AS percent
    FROM (SELECT count(*) AS n FROM (
      SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
    UNION ALL
    SELECT 'duplicate_check', n <= 1000000, n, NULL, NULL
    FROM (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_suppkey HAVING count(*) > 1))
    """,
)
def dq_duplicates(spark, sf):
    return _results(
        table(spark, sf, "lineitem"),
        [
            {"type": "duplicate", "keys": ["l_orderkey", "l_linenumber"]},
            {"type": "duplicate", "keys": ["l_suppkey"], "max_duplicates": 1_000_000},
        ],
    )


@query(
    "dq_regex",
    READINGS_SQL
    + """
    , masked AS (SELECT CASE WHEN event_type <> 'signup' THEN props END AS props, event_type FROM readings)
    SELECT 'regex_props' AS name, n * 100.0 / total <= 60 AS passed, n AS bad, total,
           round(CAST(n AS DOUBLE) / total * 100, 6) AS percent
    FROM (SELECT CAST(count_if(props IS NULL OR NOT regexp_matches(props, '^\\{"k": [0-9]\\}$')) AS BIGINT) AS n,
                 count(*) AS total FROM masked)
    UNION ALL
    SELECT 'regex_event_type', n * 100.0 / total <= 0, n, total, round(CAST(n AS DOUBLE) / total * 100, 6)
    FROM (SELECT CAST(count_if(NOT regexp_matches(event_type, '^[a-z]+$')) AS BIGINT) AS n, count(*) AS total
          FROM masked)
    """,
)
def dq_regex(spark, sf):
    """A missing text counts as a failure."""
    masked = _readings(spark, sf).withColumn("props", F.when(F.col("event_type") != "signup", F.col("props")))
    return _results(
        masked,
        [
            {"type": "regex", "column": "props", "pattern": r'^\{"k": [0-9]\}$', "max_failed_pct": 60},
            {"type": "regex", "column": "event_type", "pattern": "^[a-z]+$"},
        ],
    )


@query(
    "dq_range",
    READINGS_SQL
    + """
    SELECT 'range_value' AS name, n = 0 AS passed, n AS bad, total, round(CAST(n AS DOUBLE) / total * 100, 6) AS percent
    FROM (SELECT CAST(count_if(value < 1 OR value > 40) AS BIGINT) AS n, count(*) AS total FROM readings)
    UNION ALL
    SELECT 'range_event_id', n = 0, n, total, round(CAST(n AS DOUBLE) / total * 100, 6)
    FROM (SELECT CAST(count_if(event_id < 0) AS BIGINT) AS n, count(*) AS total FROM readings)
    UNION ALL
    SELECT 'range_user_id', true, NULL, NULL, NULL
    UNION ALL
    SELECT 'unknown_check', false, NULL, NULL, NULL
    """,
)
def dq_range(spark, sf):
    """A missing value is in range; a check without bounds passes, one of unknown type fails."""
    return _results(
        _readings(spark, sf),
        [
            {"type": "range", "column": "value", "min": 1, "max": 40},
            {"type": "range", "column": "event_id", "min": 0},
            {"type": "range", "column": "user_id"},
            {"type": "freshness", "column": "value"},
        ],
    )


# Rules over order lines and over documents.
LINE_RULES = [
    {"id": "L1", "type": "custom_sql", "expression": "l_quantity > 45", "description": "Large line",
     "category": "volume", "severity": "warning"},
    {"id": "L2", "type": "pattern", "column": "l_returnflag", "pattern": "^[AN]$", "description": "Returned",
     "category": "status", "severity": "error"},
    {"id": "L3", "type": "not_null_or_blank", "column": "l_linestatus", "description": "No status",
     "category": "status", "severity": "error"},
    {"id": "L4", "type": "custom_sql", "expression": "l_discount > l_tax"},
]
DOCUMENT_RULES = [
    {"id": "D1", "type": "pattern", "column": "lang", "pattern": "^(en|fr)$", "description": "Other language",
     "category": "language", "severity": "warning"},
    {"id": "D2", "type": "custom_sql", "expression": "n_chars < 200", "description": "Short text",
     "category": "length", "severity": "error"},
    {"id": "D3", "type": "not_null_or_blank", "column": "source", "description": "No source",
     "category": "origin", "severity": "error"},
]
AT = "2024-01-01 00:00:00"


@query(
    "dq_rule_summary",
    """
    SELECT 'L1' AS rule_id, 'Large line' AS rule, 'volume' AS category, 'warning' AS severity,
           CAST(count_if(l_quantity > 45) AS BIGINT) AS failed_count, 'lines' AS notebook_name,
           '2024-01-01 00:00:00' AS timestamp, 'b1' AS batch_id FROM lineitem
    UNION ALL
    SELECT 'L2', 'Returned', 'status', 'error', CAST(count_if(NOT regexp_matches(l_returnflag, '^[AN]$')) AS BIGINT),
           'lines', '2024-01-01 00:00:00', 'b1' FROM lineitem
    UNION ALL
    SELECT 'L3', 'No status', 'status', 'error',
           CAST(count_if(l_linestatus IS NULL OR trim(l_linestatus) = '') AS BIGINT),
           'lines', '2024-01-01 00:00:00', 'b1' FROM lineitem
    UNION ALL
    SELECT 'L4', 'Custom SQL check failed', 'unspecified', 'warning',
           CAST(count_if(l_discount > l_tax) AS BIGINT), 'lines', '2024-01-01 00:00:00', 'b1' FROM lineitem
    """,
)
def dq_rule_summary(spark, sf):
    return quality_rules.rule_summary(table(spark, sf, "lineitem"), LINE_RULES, "lines", AT, "b1")


@query(
    "dq_rejects",
    """
    WITH failed AS (
      SELECT doc_id, lang, source, n_chars, 'Other language' AS error, 'D1' AS rule_id, 'language' AS category,
             'warning' AS severity FROM documents WHERE NOT regexp_matches(lang, '^(en|fr)$')
      UNION ALL
      SELECT doc_id, lang, source, n_chars, 'Short text', 'D2', 'length', 'error' FROM documents WHERE n_chars < 200
      UNION ALL
      SELECT doc_id, lang, source, n_chars, 'No source', 'D3', 'origin', 'error' FROM documents
      WHERE source IS NULL OR trim(source) = ''
    )
    SELECT *, 'texts' AS notebook_name, '2024-01-01 00:00:00' AS timestamp FROM failed
    """,
)
def dq_rejects(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return quality_rules.rule_rejects(documents, DOCUMENT_RULES, "texts", AT)


@query(
    "dq_reject_files",
    """
    SELECT rule_id, CAST(failed AS BIGINT) AS listed, CAST(failed AS BIGINT) AS written FROM (
      SELECT 'L1' AS rule_id, count_if(l_quantity > 45) AS failed FROM lineitem
      UNION ALL SELECT 'L2', count_if(l_returnflag = 'R') FROM lineitem
      UNION ALL SELECT 'L3', count_if(trim(l_linestatus) = '') FROM lineitem
      UNION ALL SELECT 'L4', count_if(l_discount > l_tax) FROM lineitem
    )
    """,
)
def dq_reject_files(spark, sf):
    """The reject folder read back: the count listed per rule beside the rows written for it."""
    folder = quality_rules.write_rejects(
        table(spark, sf, "lineitem"), LINE_RULES, "lines", work_dir(spark, "rejects"), datetime(2024, 1, 1)
    )
    listed = spark.read.option("header", True).csv(f"{folder}/summary")
    written = spark.read.schema("rule_id string, l_orderkey bigint").json(f"{folder}/rows")
    return (
        listed.select("rule_id", F.col("failed_count").cast("bigint").alias("listed"))
        .join(written.groupBy("rule_id").agg(F.count(F.lit(1)).alias("written")), "rule_id", "left")
        .fillna(0, ["written"])
    )


@query(
    "dq_service",
    """
    WITH counts AS (
      SELECT count(*) AS total, CAST(count_if(l_quantity < 0 OR l_quantity > 100) AS BIGINT) AS wild,
             CAST(count_if(l_quantity > 10) AS BIGINT) AS large FROM lineitem
    )
    SELECT 'pass' AS run, total AS input_count, true AS schema_ok, wild = 0 AS all_passed, wild AS bad,
           total AS written FROM counts
    UNION ALL
    SELECT 'fail', total, true, false, large, 0 FROM counts
    """,
)
def dq_service(spark, sf):
    """Two runs over the order lines, one of which must not write; rows come from the audit records."""
    base = work_dir(spark, "dq-service")
    path = f"{sf.rstrip('/')}/lineitem.parquet"
    saved = spark.createDataFrame([(table(spark, sf, "lineitem").schema.json(),)], "value string")
    saved.coalesce(1).write.text(f"{base}/schema")
    written = {}
    for run, high in (("pass", 100), ("fail", 10)):
        config = quality_service.QualityConfig(
            input_path=path,
            output_path=f"{base}/{run}",
            audit_path=f"{base}/audit",
            app_name=run,
            schema_path=f"{base}/schema",
            checks=[{"type": "range", "column": "l_quantity", "min": 0, "max": high}],
        )
        record = quality_service.run_quality(spark, config)
        written[run] = spark.read.parquet(config.output_path).count() if record["all_passed"] else 0
    audit = spark.read.schema(quality_service.AUDIT_SCHEMA).json(f"{base}/audit")
    return audit.select(
        F.col("app").alias("run"),
        "input_count",
        "schema_ok",
        "all_passed",
        F.col("checks")[0]["bad"].alias("bad"),
        F.when(F.col("app") == "pass", written["pass"]).otherwise(written["fail"]).cast("bigint").alias("written"),
    )


EXPECTED_ORDER = (
    "o_orderkey bigint, o_custkey bigint, o_totalprice decimal(12,2), o_clerk string, o_orderpriority string"
)


@query(
    "schema_diff",
    """
    SELECT * FROM (VALUES
      ('Missing Columns', 'o_clerk', 'string', NULL, CAST(0 AS BIGINT)),
      ('Unexpected Columns', 'o_orderdate', NULL, 'timestamp_ntz', (SELECT count(o_orderdate) FROM orders)),
      ('Unexpected Columns', 'o_orderstatus', NULL, 'string', (SELECT count(o_orderstatus) FROM orders)),
      ('Different Types', 'o_totalprice', 'decimal(12,2)', 'double', (SELECT count(o_totalprice) FROM orders))
    ) AS t(issue, column_name, expected, found, "values")
    """,
)
def schema_diff(spark, sf):
    """What keeps the orders out of a table, and how many values each mismatch concerns."""
    orders = table(spark, sf, "orders")
    issues = schema_gate.schema_issues(orders.schema, T.StructType.fromDDL(EXPECTED_ORDER), strict=True, types=True)
    counts = orders.agg(*[F.count(column).alias(column) for _, column, _, found in issues if found])
    held = counts.unpivot([], counts.columns, "column_name", "values")
    return schema_gate.issues_frame(spark, issues).join(held, "column_name", "left").fillna(0, ["values"])


@query(
    "rules_from_file",
    """
    SELECT 'big' AS rule_id, CAST(count_if(l_quantity > 40) AS BIGINT) AS failed_count FROM lineitem
    UNION ALL
    SELECT 'mode', CAST(count_if(l_returnflag IS NOT NULL AND NOT regexp_matches(l_returnflag, '^[AN]$')) AS BIGINT)
    FROM lineitem
    """,
)
def rules_from_file(spark, sf):
    """A list of rules kept as JSON, written and read as a file."""
    rules = [
        {"id": "big", "type": "custom_sql", "expression": "l_quantity > 40", "description": "large", "category": "size"},
        {"id": "mode", "type": "pattern", "column": "l_returnflag", "pattern": "^[AN]$", "description": "kept"},
    ]
    path = f"{work_dir(spark, 'rules')}/list"
    spark.range(1).select(F.lit(json.dumps(rules, indent=2)).alias("value")).coalesce(1).write.text(path)
    loaded = quality_rules.load_rules(spark, path)
    summary = quality_rules.rule_summary(table(spark, sf, "lineitem"), loaded, "job", "now", "batch")
    return summary.select("rule_id", "failed_count")


@query(
    "error_log_report",
    """
    WITH loads AS (
      SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS status,
             count(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END) AS price
      FROM orders GROUP BY ALL
    )
    SELECT concat_ws(' ', 'load', CAST(o_custkey AS VARCHAR), CAST(day AS VARCHAR)) AS "NotebookPath", 'ops' AS "Username",
           'Missing Columns' AS issue, column_name
    FROM (
      SELECT *, 'o_clerk' AS column_name FROM loads
      UNION ALL SELECT *, 'o_orderstatus' FROM loads WHERE status = 0
      UNION ALL SELECT *, 'o_totalprice' FROM loads WHERE price = 0
    )
    """,
)
def error_log_report(spark, sf):
    """What each customer's orders of a day lack, logged as a JSON record per load and read back through a glob."""
    log = f"{work_dir(spark, 'errors')}/log"
    orders = table(spark, sf, "orders").select(
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
    )
    issues = schema_gate.load_issues(orders, ["o_custkey", "day"], ["o_orderstatus", "o_totalprice", "o_clerk"])
    job = F.concat_ws(" ", F.lit("load"), F.col("o_custkey").cast("string"), F.col("day").cast("string"))
    schema_gate.log_issue_rows(issues, log, job, user="ops")
    report = schema_gate.error_report(spark, f"{log}/*.json").select("NotebookPath", "Username", F.explode("Errors"))
    return report.select("NotebookPath", "Username", F.col("key").alias("issue"), F.explode("value").alias("column_name"))


@query(
    "gated_write",
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_clerk
    FROM orders
    """,
)
def gated_write(spark, sf):
    """The first write lacks a column and is refused; the second may fill it with null."""
    base = work_dir(spark, "gated")
    name = f"gated_{base[-32:]}"
    expected = T.StructType.fromDDL("o_orderkey bigint, o_custkey string, o_totalprice double, o_clerk string")
    spark.createDataFrame([], expected).write.option("path", f"{base}/table").saveAsTable(name)
    orders = table(spark, sf, "orders")
    refused = schema_gate.gated_write(orders, name, f"{base}/log")
    if not refused or spark.table(name).head(1):
        raise AssertionError("the gate let incomplete rows in")
    schema_gate.gated_write(orders, name, f"{base}/log", add_missing=True)
    rows = spark.read.schema(expected).parquet(f"{base}/table")
    spark.sql(f"DROP TABLE {name}")
    return rows
