"""Row rules kept as data: failing rows, their summary, and the reject folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.predicates import blank, not_matching

# What a rule says when it leaves a field out.
RULE_DEFAULTS = {
    "id": "NA",
    "description": "Custom SQL check failed",
    "category": "unspecified",
    "severity": "warning",
}

# Column of a reject, and the field of the rule it comes from.
TAGS = {"error": "description", "rule_id": "id", "category": "category", "severity": "severity"}


def load_rules(spark: SparkSession, path: str) -> list[dict]:
    """Rules from a JSON list; a missing file is an error at once."""
    rows = spark.read.option("multiLine", True).json(path).collect()
    return [{k: v for k, v in row.asDict().items() if v is not None} for row in rows]


def _said(rule: Mapping, field: str) -> str:
    return str(rule.get(field, RULE_DEFAULTS[field]))


def failing(rule: Mapping) -> Column | None:
    """True for the rows that break the rule, false or null for others; None if the type is unknown."""
    kind = rule.get("type")
    if kind == "not_null_or_blank":
        return blank(F.col(rule["column"]))
    if kind == "pattern":
        return not_matching(F.col(rule["column"]), rule["pattern"], rule.get("null_fails", False))
    if kind == "custom_sql":
        return F.expr(rule["expression"])
    return None


def _broken(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Each row once per rule it breaks, with the place of the rule as ``_rule``."""
    conditions = [(place, failing(rule)) for place, rule in enumerate(rules)]
    conditions = [(place, condition) for place, condition in conditions if condition is not None]
    if not conditions:
        return df.where(F.lit(False)).withColumn("_rule", F.lit(0))
    # Rows that break no rule, usually nearly all, are out before any place is listed.
    broken = df.where(reduce(Column.__or__, [condition for _, condition in conditions]))
    places = F.array(*[F.when(condition, F.lit(place)) for place, condition in conditions])
    return broken.withColumn("_rule", F.explode(F.array_compact(places)))


def _tagged(broken: DataFrame, rules: Sequence[Mapping], job: str, at: str) -> DataFrame:
    """What the rule at ``_rule`` says about each row, instead of its place."""
    said = [F.struct(*[F.lit(_said(rule, field)).alias(name) for name, field in TAGS.items()]) for rule in rules]
    none = F.struct(*[F.lit(None).cast("string").alias(name) for name in TAGS])
    tagged = broken.withColumn("_tag", F.get(F.array(*(said or [none])), F.col("_rule")))
    return tagged.drop("_rule").select("*", "_tag.*", F.lit(job).alias("notebook_name"), F.lit(at).alias("timestamp")).drop("_tag")


def rule_rejects(df: DataFrame, rules: Sequence[Mapping], job: str, at: str) -> DataFrame:
    """Each row once per rule it breaks, tagged with the rule; one scan, no shuffle."""
    return _tagged(_broken(df, rules), rules, job, at)


def rule_summary(
    df: DataFrame, rules: Sequence[Mapping], job: str, at: str, batch_id: str | None = None
) -> DataFrame:
    """Failed rows per rule, all counted in one scan; rules nobody breaks show 0.

    A rule of an unknown type is listed as an error without a count.
    """
    counts, rows = [F.count(F.lit(1)).alias("_rows")], []
    for place, rule in enumerate(rules):
        condition = failing(rule)
        if condition is not None:
            counts.append(F.count_if(condition).alias(f"_failed{place}"))
        known = condition is not None
        rows.append(
            F.struct(
                F.lit(_said(rule, "id")).alias("rule_id"),
                F.lit(_said(rule, "description") if known else f"Unknown rule type: {rule.get('type')}").alias("rule"),
                F.lit(_said(rule, "category")).alias("category"),
                F.lit(_said(rule, "severity") if known else "error").alias("severity"),
                (F.col(f"_failed{place}") if known else F.lit(None)).cast("bigint").alias("failed_count"),
            )
        )
    if not rows:
        raise ValueError("there are no rules")
    summary = (
        df.agg(*counts)
        .select(F.inline(F.array(*rows)))
        .withColumns({"notebook_name": F.lit(job), "timestamp": F.lit(at)})
    )
    return summary if batch_id is None else summary.withColumn("batch_id", F.lit(batch_id))


def write_rejects(df: DataFrame, rules: Sequence[Mapping], job: str, base: str, at: datetime) -> str:
    """Write the summary as CSV and, if any row failed, the failing rows as JSON by rule, in gzip.

    Returns the folder, which is named by the time.
    """
    folder = f"{base.rstrip('/')}/rejects_{at:%Y-%m-%dT%H-%M-%S}"
    stamp = str(at)
    # The written summary is read back, so the scan behind it runs once.
    summary = rule_summary(df, rules, job, stamp)
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/summary")
    written = df.sparkSession.read.schema(summary.schema).option("header", True).csv(f"{folder}/summary")
    if written.where("failed_count > 0").head(1):
        # Only the place of a rule is shuffled beside the row; what it says is added where rows are written.
        rejects = _tagged(_broken(df, rules).hint("rebalance", "_rule"), rules, job, stamp)
        rejects.write.mode("append").partitionBy("rule_id").json(f"{folder}/rows", compression="gzip")
    return folder
