"""Table-level checks with thresholds: all of them from one scan, plus one grouping per key set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.predicates import not_matching, outside, true_only
from lakeops.operators.dedup import repeated_keys

RESULT_FIELDS = ("name", "passed", "bad", "total", "percent", "allowed", "message")


def _result(name: str, passed: Column, bad=None, total=None, percent=None, allowed=None, message=None) -> Column:
    values = (
        (F.lit(name), "string"),
        (passed, "boolean"),
        (F.lit(bad), "bigint"),
        (F.lit(total), "bigint"),
        (F.lit(percent), "double"),
        (F.lit(allowed), "double"),
        (F.lit(message), "string"),
    )
    return F.struct(*[value.cast(kind).alias(field) for field, (value, kind) in zip(RESULT_FIELDS, values)])


def _bad_rows(check: Mapping) -> Column | None:
    """Rows a scan check counts as bad; None if it has nothing to look at."""
    kind, column = check["type"], F.col(check["column"])
    if kind == "null_pct":
        return column.isNull()
    if kind == "regex":
        return not_matching(column, check["pattern"], check.get("null_fails", True))
    return outside(column, check.get("min"), check.get("max"))


# Result name, and the check's key that holds the allowed percentage; a range allows no bad row.
SCAN_CHECKS = {
    "null_pct": ("null_pct_{column}", "max_percent"),
    "regex": ("regex_{column}", "max_failed_pct"),
    "range": ("range_{column}", None),
}


def check_results(df: DataFrame, checks: Sequence[Mapping]) -> DataFrame:
    """One row per check, in the order given. An unknown type is a failed check."""
    counts: dict[str, Column] = {"_total": F.count(F.lit(1))}
    from_scan: list[Column] = []
    from_groups: list[DataFrame] = []
    for place, check in enumerate(checks):
        kind = check.get("type")
        if kind in SCAN_CHECKS:
            pattern, allowed_key = SCAN_CHECKS[kind]
            name = pattern.format(column=check["column"])
            condition = _bad_rows(check)
            if condition is None:
                result = _result(name, F.lit(True), message="skipped")
            else:
                counts[f"_bad{place}"] = F.count_if(true_only(condition))
                bad, total = F.col(f"_bad{place}"), F.col("_total")
                percent = F.coalesce(F.try_divide(bad, total) * 100, F.lit(0.0))
                allowed = float(check.get(allowed_key, 0.0)) if allowed_key else 0.0
                result = _result(name, percent <= allowed, bad, total, percent, allowed)
            from_scan.append(F.struct(F.lit(place).alias("place"), result.alias("result")))
        elif kind == "duplicate":
            groups = repeated_keys(df, check["keys"]).agg(F.count(F.lit(1)).alias("groups"))
            allowed = float(check.get("max_duplicates", 0))
            result = _result(
                "duplicate_check",
                F.col("groups") <= allowed,
                F.col("groups"),
                allowed=allowed,
                message="keys: " + ", ".join(check["keys"]),
            )
            from_groups.append(groups.select(F.lit(place).alias("place"), result.alias("result")))
        else:
            result = _result("unknown_check", F.lit(False), message=f"Unknown check type: {kind}")
            from_scan.append(F.struct(F.lit(place).alias("place"), result.alias("result")))
    parts = list(from_groups)
    if from_scan:
        # One row of counts, turned into one row per check.
        scanned = df.agg(*[value.alias(name) for name, value in counts.items()])
        parts.append(scanned.select(F.inline(F.array(*from_scan))))
    if not parts:
        schema = "name string, passed boolean, bad bigint, total bigint, percent double, allowed double, message string"
        return df.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts).orderBy("place").select("result.*")
