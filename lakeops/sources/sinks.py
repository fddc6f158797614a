"""Sinks for parquet, CSV, JSON and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import one_row
from lakeops.sources.layout import in_files
from lakeops.sources.readers import CORRUPT, input_bytes, partitions_for


def write_files(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Write files of any format.

    With ``partition_by``, rows are first gathered by folder, so that not every task writes to every folder;
    Spark splits a folder that holds much of the data over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).format(format).options(**options).partitionBy(*partition_by).save(path)


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).saveAsTable(name)


def write_sized(df: DataFrame, path: str, target_mb: int = 128, source_bytes: int | None = None) -> int:
    """Write in files of about ``target_mb``, going by the size of the input files."""
    files = partitions_for(input_bytes(df) if source_bytes is None else source_bytes, target_mb)
    in_files(df, files).write.mode("overwrite").parquet(path)
    return files


def split_corrupt(parsed: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """Write parsed lines by whether they fit the schema; returns the clean and the quarantined rows.

    One pass parses and writes both: the folders ``corrupt=false`` and ``corrupt=true`` under ``base``.
    """
    spark = parsed.sparkSession
    flagged = parsed.withColumn("corrupt", F.col(CORRUPT).isNotNull())
    flagged.write.mode("overwrite").partitionBy("corrupt").parquet(base)
    written = spark.read.schema(flagged.schema).parquet(base)
    return written.where("not corrupt").drop("corrupt", CORRUPT), written.where("corrupt").drop("corrupt")


def append_record(spark: SparkSession, record: Mapping, schema: str, path: str) -> None:
    """Append one JSON line to a dataset of records."""
    one_row(spark, record, schema).write.mode("append").json(path)
