"""Writes that happen only if the data has the expected columns."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources.sinks import append_record

# The control table's type names; any other name means string.
CONTROL_TYPES = {"STRING": T.StringType(), "FLOAT": T.FloatType(), "TIMESTAMP": T.TimestampType()}

# Fields of an issue and of a logged error, and the names of the issues.
ISSUE_SCHEMA = "issue string, column_name string, expected string, found string"
ERROR_LOG_SCHEMA = (
    "metadata struct<notebook_path: string, timestamp_utc: string, user: string, cluster_id: string>, "
    "errors map<string, array<string>>"
)
MISSING, UNEXPECTED, WRONG_TYPE = "Missing Columns", "Unexpected Columns", "Different Types"


def schema_from_json(spark: SparkSession, path: str) -> T.StructType:
    """Schema saved in Spark's JSON form."""
    text = "".join(row.value for row in spark.read.option("wholetext", True).text(path).collect())
    return T.StructType.fromJson(json.loads(text))


def schema_from_control(rows: Sequence[Mapping], types: Mapping[str, T.DataType] = CONTROL_TYPES) -> T.StructType:
    """Schema from control rows ``column_name, data_type, nullable, ordinal_position``."""
    ordered = sorted(rows, key=lambda row: row["ordinal_position"])
    return T.StructType(
        [
            T.StructField(row["column_name"], types.get(row["data_type"].upper(), T.StringType()), row["nullable"])
            for row in ordered
        ]
    )


def schema_issues(
    found: T.StructType, expected: T.StructType | Sequence[str] | None, strict: bool = True, types: bool = False
) -> list[tuple[str, str, str | None, str | None]]:
    """Issues as ``(issue, column, expected type, found type)``.

    ``strict`` also reports columns that are not expected, ``types`` also columns of another type. Without
    an expected schema there are none.
    """
    if expected is None:
        return []
    wanted = {f.name: f.dataType for f in expected} if isinstance(expected, T.StructType) else dict.fromkeys(expected)
    actual = {f.name: f.dataType for f in found}

    def shown(kind):
        return kind.simpleString() if kind is not None else None

    issues = [(MISSING, name, shown(kind), None) for name, kind in wanted.items() if name not in actual]
    if strict:
        issues += [(UNEXPECTED, name, None, shown(kind)) for name, kind in actual.items() if name not in wanted]
    if types:
        issues += [
            (WRONG_TYPE, name, shown(kind), shown(actual[name]))
            for name, kind in wanted.items()
            if kind is not None and name in actual and actual[name] != kind
        ]
    return issues


def issues_frame(spark: SparkSession, issues: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(issues), ISSUE_SCHEMA)


def table_schema(spark: SparkSession, name: str) -> T.StructType | None:
    """Schema of a catalog table; None if there is no such table."""
    return spark.table(name).schema if spark.catalog.tableExists(name) else None


def log_issues(
    spark: SparkSession, issues: Sequence[tuple], log_path: str, job: str, user: str = "", cluster: str = ""
) -> None:
    """Append one JSON record: who and when, and the columns per kind of issue."""
    errors: dict[str, list[str]] = {}
    for issue, column, *_ in issues:
        errors.setdefault(issue, []).append(column)
    metadata = {
        "notebook_path": job,
        "timestamp_utc": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "user": user,
        "cluster_id": cluster,
    }
    record = {"metadata": metadata, "errors": {issue: sorted(columns) for issue, columns in errors.items()}}
    append_record(spark, record, ERROR_LOG_SCHEMA, log_path)


def load_issues(df: DataFrame, load: Sequence[str], required: Sequence[str]) -> DataFrame:
    """``load`` columns, ``issue`` and ``column_name``: what each load of the data lacks.

    A load is the rows that are equal in the ``load`` columns; it lacks a required column if none of its rows has a
    value there, or if the data has no such column at all. One aggregation for all loads, so a load may hold any part of
    the rows.
    """
    values = [F.count(F.col(name) if name in df.columns else F.lit(None)).alias(f"_n{i}") for i, name in enumerate(required)]
    lacking = [F.when(F.col(f"_n{i}") == 0, F.lit(name)) for i, name in enumerate(required)]
    counted = df.groupBy(*load).agg(*values)
    return counted.select(*load, F.lit(MISSING).alias("issue"), F.explode(F.array_compact(F.array(*lacking))).alias("column_name"))


def log_issue_rows(issues: DataFrame, log_path: str, job: Column, user: str = "", cluster: str = "") -> None:
    """Append one JSON record per job for rows of ``issue`` and ``column_name``, all in one distributed write.

    Columns of an issue are named once, in order; as many as the tables have columns, so a job's record is one row.
    """
    named = issues.select(job.alias("job"), "issue", "column_name").distinct()
    columns = named.groupBy("job", "issue").agg(F.sort_array(F.collect_list("column_name")).alias("columns"))
    per_issue = F.sort_array(F.collect_list(F.struct("issue", "columns")))
    errors = columns.groupBy("job").agg(F.map_from_entries(per_issue).alias("errors"))
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    metadata = F.struct(
        F.col("job").alias("notebook_path"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp_utc"),
        F.lit(user).alias("user"),
        F.lit(cluster).alias("cluster_id"),
    )
    errors.select(metadata.alias("metadata"), "errors").write.mode("append").json(log_path)


def error_report(spark: SparkSession, path: str) -> DataFrame:
    """Flat rows of the logged records; ``path`` may be a glob."""
    # The names of the report's columns.
    return spark.read.schema(ERROR_LOG_SCHEMA).json(path).selectExpr(
        "metadata.notebook_path as NotebookPath",
        "metadata.timestamp_utc as TimestampUTC",
        "metadata.user as Username",
        "metadata.cluster_id as ClusterID",
        "errors as Errors",
    )


def conform(df: DataFrame, expected: T.StructType, add_missing: bool = False) -> DataFrame:
    """The expected columns in their order and type; values that cannot be cast raise."""
    columns = []
    for field in expected:
        if field.name in df.columns:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif add_missing:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"column {field.name!r} is missing")
    return df.select(*columns)


def gated_write(
    df: DataFrame,
    target: str,
    log_path: str,
    expected: T.StructType | None = None,
    strict: bool = False,
    add_missing: bool = False,
    mode: str = "append",
    job: str = "gated_write",
) -> list[tuple]:
    """Write to the catalog table ``target`` if the columns fit; log the issues and write nothing otherwise.

    The expected schema defaults to the table's own; a missing table is an issue, too. ``add_missing``
    fills columns the data lacks with null instead of refusing it. Returns the issues that kept the data out.
    """
    spark = df.sparkSession
    expected = expected if expected is not None else table_schema(spark, target)
    if expected is None:
        issues = [("Missing Table", target, None, None)]
    else:
        issues = schema_issues(df.schema, expected, strict)
        if add_missing:
            issues = [issue for issue in issues if issue[0] != MISSING]
    if issues:
        log_issues(spark, issues, log_path, job)
        return issues
    conform(df, expected, add_missing).write.mode(mode).saveAsTable(target)
    return []
