"""Ingest of raw files driven by control tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.predicates import all_present
from lakeops.operators.relational import enrich
from lakeops.plans.schema_gate import schema_from_control
from lakeops.sources.readers import read_from_config

# Fixed value: how sensor feeds write times.
FEED_TIME = "yyyy-MM-dd'T'HH:mm:ss"


@dataclass(frozen=True)
class ControlTables:
    """Small tables that say how a source is read, renamed and checked."""

    config: DataFrame
    columns: DataFrame
    mapping: DataFrame
    rules: DataFrame


@dataclass(frozen=True)
class SourcePlan:
    config: dict
    columns: list[dict]
    mapping: dict[str, str]
    rules: list[str]
    target: str


def source_plan(control: ControlTables, source_name: str) -> SourcePlan:
    """Rows of the control tables that concern one source.

    Mapping and rules are found by joins on the schema id, not by lists of ids.
    """
    config = control.config.where(F.col("source_name") == source_name).first()
    if config is None:
        raise ValueError(f"no source named {source_name!r}")
    columns = control.columns.where(F.col("source_config_id") == config["source_config_id"])
    ids = columns.select("schema_id").distinct()
    mapping = control.mapping.join(ids, "schema_id", "left_semi").collect()
    rules = control.rules.join(ids, "schema_id", "left_semi").select("validation_expression").distinct().collect()
    targets = {row["target_table_name"] for row in mapping}
    if len(targets) != 1:
        raise ValueError(f"source {source_name!r} has {len(targets)} target tables instead of one")
    return SourcePlan(
        config=config.asDict(recursive=True),
        columns=[row.asDict() for row in columns.orderBy("ordinal_position").collect()],
        mapping={row["source_column_name"]: row["target_column_name"] for row in mapping},
        rules=[row["validation_expression"] for row in rules],
        target=targets.pop(),
    )


def apply_plan(raw: DataFrame, plan: SourcePlan) -> DataFrame:
    """Hints on the source names, then the renames, then the rules on the new names.

    Hints go in the order of the columns, so one sees what those before it made. A rule keeps the rows for which it is
    true.
    """
    hinted = raw
    for column in plan.columns:
        if column["transformation_hint"]:
            hinted = hinted.withColumn(column["column_name"], F.expr(column["transformation_hint"]))
    renamed = hinted.withColumnsRenamed(plan.mapping)
    for rule in plan.rules:
        renamed = renamed.where(rule)
    return renamed


def enrich_readings(
    feed: DataFrame, sensors: DataFrame, units: DataFrame, source_name: str, given_keys: Sequence[str] = ()
) -> DataFrame:
    """Parse the time, add sensor and unit, and say where each reading comes from.

    A reading's id is a hash of source, equipment and time, and of ``given_keys`` where those do not tell readings apart.
    """
    named = feed.withColumnsRenamed({"device_id": "equipment_id"}).withColumn(
        "timestamp", F.try_to_timestamp(F.col("timestamp").cast("string"), F.lit(FEED_TIME))
    )
    joined = enrich(
        named,
        (sensors.select("equipment_id", "sensor_id", "unit_id"), "equipment_id"),
        (units.select("unit_id", "unit_type"), "unit_id"),
    )
    return joined.withColumnsRenamed({"power": "metric_value", "unit_type": "metric_name"}).withColumns(
        {
            # The same reading gets the same id whenever it is read.
            "reading_id": F.sha2(
                F.concat_ws("|", F.lit(source_name), "equipment_id", F.col("timestamp").cast("string"), *given_keys), 256
            ),
            "metadata": F.create_map(F.lit("source"), F.lit(source_name)),
        }
    )


def not_null_columns(target: T.StructType) -> list[str]:
    """Columns that the target table requires."""
    return [field.name for field in target if not field.nullable]


def flag_quality(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``quality_flag`` is Valid where every required column has a value."""
    return df.withColumn("quality_flag", F.when(all_present(required), "Valid").otherwise("Invalid"))


def ingest(
    spark: SparkSession,
    control: ControlTables,
    source_name: str,
    sensors: DataFrame,
    units: DataFrame,
    target: T.StructType,
) -> DataFrame:
    """Readings of a source, from its files to the last lookup, flagged by what the target requires."""
    plan = source_plan(control, source_name)
    raw = read_from_config(spark, plan.config, schema_from_control(plan.columns))
    return flag_quality(enrich_readings(apply_plan(raw, plan), sensors, units, source_name), not_null_columns(target))


def write_by_quality(flagged: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """Write valid and invalid rows in one pass, to a folder each; returns both."""
    spark = flagged.sparkSession
    flagged.write.mode("overwrite").partitionBy("quality_flag").parquet(base)
    written = spark.read.schema(flagged.schema).parquet(base)
    return written.where("quality_flag = 'Valid'"), written.where("quality_flag = 'Invalid'")
