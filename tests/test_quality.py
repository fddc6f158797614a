import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.plans import quality_rules, schema_gate
from lakeops.plans.quality_checks import check_results
from lakeops.plans.quality_service import AUDIT_SCHEMA, QualityConfig, run_quality

RULES = [
    {"id": "R1", "type": "not_null_or_blank", "column": "name", "description": "Name missing", "category": "complete",
     "severity": "error"},
    {"id": "R2", "type": "pattern", "column": "mail", "pattern": "^[^@]+@[^@]+$", "description": "Bad mail",
     "category": "format", "severity": "warning"},
    {"type": "custom_sql", "expression": "amount < 0"},
    {"id": "R4", "type": "pattern", "column": "name", "pattern": ".", "description": "Never", "category": "c",
     "severity": "info"},
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("Ann", "ann@x.org", 5.0), ("  ", "bad", -1.0), (None, None, None), ("Dan", "dan@y.org", 200.0)],
        "name string, mail string, amount double",
    )


def test_row_rules(people, rows):
    summary = quality_rules.rule_summary(people, RULES, "job", "now")
    assert rows(summary, "rule_id", "rule", "severity", "failed_count") == [
        ("NA", "Custom SQL check failed", "warning", 1),
        ("R1", "Name missing", "error", 2),
        ("R2", "Bad mail", "warning", 1),
        ("R4", "Never", "info", 0),
    ]
    rejects = quality_rules.rule_rejects(people, RULES, "job", "now")
    assert rows(rejects, "name", "rule_id", "category", "notebook_name", "timestamp") == [
        ("  ", "NA", "unspecified", "job", "now"),
        ("  ", "R1", "complete", "job", "now"),
        ("  ", "R2", "format", "job", "now"),
        (None, "R1", "complete", "job", "now"),
    ]


def test_unknown_rule_is_listed_and_null_policy_can_be_set(people, rows):
    rules = [{"id": "U", "type": "odd"}, {**RULES[1], "null_fails": True}]
    assert rows(quality_rules.rule_summary(people, rules, "j", "t"), "rule", "severity", "failed_count") == [
        ("Bad mail", "warning", 2), ("Unknown rule type: odd", "error", None)]
    assert quality_rules.rule_rejects(people, rules[:1], "j", "t").count() == 0


def test_reject_folder(spark, people, tmp_path, rows):
    (tmp_path / "rules.json").write_text(json.dumps(RULES))
    rules = quality_rules.load_rules(spark, str(tmp_path / "rules.json"))
    assert [rule.get("id") for rule in rules] == ["R1", "R2", None, "R4"]
    folder = quality_rules.write_rejects(people, rules, "job", str(tmp_path), datetime(2024, 5, 6, 7, 8, 9))
    assert folder.endswith("/rejects_2024-05-06T07-08-09")
    assert spark.read.option("header", True).csv(f"{folder}/summary").count() == 4
    assert spark.read.json(f"{folder}/rows").count() == 4
    clean = quality_rules.write_rejects(people.limit(0), rules, "job", str(tmp_path), datetime(2025, 1, 1))
    assert not (tmp_path / clean.split("/")[-1] / "rows").exists()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        quality_rules.load_rules(spark, str(tmp_path / "absent.json"))


CHECKS = [
    {"type": "null_pct", "column": "name", "max_percent": 25},
    {"type": "null_pct", "column": "name", "max_percent": 24},
    {"type": "regex", "column": "mail", "pattern": "@", "max_failed_pct": 50},
    {"type": "regex", "column": "mail", "pattern": "@", "null_fails": False},
    {"type": "range", "column": "amount", "min": 0, "max": 100},
    {"type": "range", "column": "amount", "max": 500},
    {"type": "range", "column": "amount"},
    {"type": "duplicate", "keys": ["name"]},
    {"type": "weird"},
]


def test_reject_files_hold_all_rejects_in_few_bytes(spark, rows, tmp_path):
    people = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("name"), (F.col("id") * 7).alias("number")
    )
    rules = [
        {"id": "R1", "type": "not_null_or_blank", "column": "name", "description": "No name", "severity": "error"},
        {"id": "unknown", "type": "other"},
        {"id": "R2", "type": "custom_sql", "expression": "number % 2 = 0"},
    ]
    folder = quality_rules.write_rejects(people, rules, "job", str(tmp_path), datetime(2024, 5, 6))
    want = quality_rules.rule_rejects(people, rules, "job", "2024-05-06 00:00:00")
    assert want.count() == 6667 + 10_000
    written = spark.read.schema(want.schema).json(f"{folder}/rows")
    assert rows(written, *want.columns) == rows(want)
    want.select(F.to_json(F.struct("*"))).write.text(str(tmp_path / "plain"))
    size = lambda place: sum(f.stat().st_size for f in place.rglob("part-*"))
    assert size(Path(folder) / "rows") < size(tmp_path / "plain") / 4


def test_checks(spark, people):
    got = [(r.name, r.passed, r.bad) for r in check_results(people, CHECKS).collect()]
    assert got == [
        ("null_pct_name", True, 1),
        ("null_pct_name", False, 1),
        ("regex_mail", True, 2),
        ("regex_mail", False, 1),
        ("range_amount", False, 2),
        ("range_amount", True, 0),
        ("range_amount", True, None),
        ("duplicate_check", True, 0),
        ("unknown_check", False, None),
    ]
    assert check_results(people, []).count() == 0


def test_duplicates_are_counted_in_full(spark):
    df = spark.createDataFrame([(k,) for k in (1, 1, 2, 2, 2, 3)], "k int")
    checks = [{"type": "duplicate", "keys": ["k"], "max_duplicates": n} for n in (0, 1, 2)]
    assert [(r.bad, r.passed) for r in check_results(df, checks).collect()] == [(2, False), (2, False), (2, True)]


def test_empty_input_passes(people):
    results = check_results(people.limit(0), CHECKS[:8]).collect()
    assert all(r.passed for r in results)


def test_checks_share_one_scan(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    plan = check_results(df, CHECKS[:7])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def config(tmp_path, **changes):
    settings = {
        "input_path": str(tmp_path / "in"),
        "output_path": str(tmp_path / "out"),
        "audit_path": str(tmp_path / "audit"),
        "checks": [{"type": "range", "column": "id", "min": 0}],
        "unique_keys": ["id"],
        "min_partitions": 3,
    }
    return QualityConfig(**{**settings, **changes})


def test_service_writes_only_if_all_passed(spark, tmp_path, rows):
    data = spark.range(10)
    data.write.parquet(str(tmp_path / "in"))
    record = run_quality(spark, config(tmp_path))
    assert record["all_passed"] and record["input_count"] == 10 and record["unique_check"]["passed"]
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(data)

    other = str(tmp_path / "never")
    small = [{"type": "range", "column": "id", "max": 3}]
    failed = run_quality(spark, config(tmp_path, output_path=other, checks=small))
    assert not failed["all_passed"] and failed["checks"][0]["bad"] == 6
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("gone", T.StringType())])
    (tmp_path / "schema.json").write_text(json.dumps(schema.jsonValue(), indent=1))
    unfit = run_quality(spark, config(tmp_path, output_path=other, schema_path=str(tmp_path / "schema.json")))
    assert unfit["schema_issues"] == ["Missing Columns: gone"] and not unfit["all_passed"]
    assert not (tmp_path / "never").exists()

    with pytest.raises(Exception):
        run_quality(spark, config(tmp_path, checks=[{"type": "range", "column": "nope", "min": 0}]))
    audit = spark.read.schema(AUDIT_SCHEMA).json(str(tmp_path / "audit"))
    assert audit.count() == 4
    assert audit.where("error is not null and all_passed is null").count() == 1


def test_schema_issues():
    found = T.StructType([T.StructField("a", T.LongType()), T.StructField("x", T.StringType())])
    expected = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert schema_gate.schema_issues(found, expected, strict=False) == [("Missing Columns", "b", "string", None)]
    assert [i[0] for i in schema_gate.schema_issues(found, expected, types=True)] == [
        "Missing Columns", "Unexpected Columns", "Different Types"]
    assert schema_gate.schema_issues(found, ["a"], strict=False) == []
    assert schema_gate.schema_issues(found, None) == []


def test_issue_records_of_many_loads(spark, tmp_path, rows):
    """One load holds most rows; a load lacks a column only if no row of it has a value."""
    data = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("load"),
        F.when(F.col("id") % 7 != 3, F.col("id")).alias("a"),
        F.lit(None).cast("string").alias("b"),
    )
    issues = schema_gate.load_issues(data, ["load"], ["a", "b", "c"])
    log = str(tmp_path / "log")
    schema_gate.log_issue_rows(issues.union(issues), log, F.concat(F.lit("job "), "load"), user="me", cluster="k")
    schema_gate.log_issue_rows(issues.limit(0), log, F.col("load"))
    report = schema_gate.error_report(spark, f"{log}/*.json")
    found = {r.NotebookPath: r.Errors for r in report.collect()}
    assert len(found) == report.count() == 8
    assert found["job big"] == {"Missing Columns": ["b", "c"]} and found["job s3"] == {"Missing Columns": ["a", "b", "c"]}
    first = report.first()
    assert (first.Username, first.ClusterID) == ("me", "k") and first.TimestampUTC.endswith("Z") and len(first.TimestampUTC) == 20


def test_schema_from_control_rows():
    rows = [
        {"column_name": "b", "data_type": "float", "nullable": True, "ordinal_position": 2},
        {"column_name": "a", "data_type": "GEOMETRY", "nullable": False, "ordinal_position": 1},
    ]
    assert schema_gate.schema_from_control(rows) == T.StructType(
        [T.StructField("a", T.StringType(), False), T.StructField("b", T.FloatType(), True)])


def test_gated_write(spark, tmp_path, rows):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([("A", 1, "x")], "product string, revenue int, extra string")
    name = f"gate_{tmp_path.name.replace('-', '_')}"
    assert schema_gate.gated_write(df, name, log)[0][0] == "Missing Table"
    spark.createDataFrame([], "revenue bigint, product string").write.mode("overwrite").option(
        "path", str(tmp_path / "table")
    ).saveAsTable(name)
    assert schema_gate.gated_write(df.drop("revenue"), name, log) == [("Missing Columns", "revenue", "bigint", None)]
    assert [i[1] for i in schema_gate.gated_write(df, name, log, strict=True)] == ["extra"]
    assert spark.table(name).count() == 0
    assert schema_gate.gated_write(df, name, log) == []
    assert schema_gate.gated_write(df.drop("product"), name, log, add_missing=True) == []
    assert rows(spark.table(name), "product", "revenue") == [("A", 1), (None, 1)]
    report = schema_gate.error_report(spark, f"{log}/*.json")
    assert rows(report.select(F.explode("Errors")))[0] == ("Missing Columns", ["revenue"])
    assert report.count() == 3
    spark.sql(f"DROP TABLE {name}")
