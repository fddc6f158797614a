"""Readers for files, paths and parameterised SQL."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Fields of a product record. Prices may have decimals and images come as a list.
PRODUCT_SCHEMA = (
    "id int, title string, description string, price double, discountPercentage double, rating double, "
    "stock int, brand string, category string, thumbnail string, images array<string>"
)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).csv(path)


def read_csv_permissive(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV in which a line that does not fit the schema is kept as text in ``_corrupt_record``."""
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_json(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON; without a schema it is inferred, which reads everything once more. ``path`` may be a glob.

    ``multi_line`` reads each file as one document, which then cannot be split between tasks.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Landed product payloads with their declared schema."""
    return read_json(spark, path, PRODUCT_SCHEMA)


def read_with_floor(
    spark: SparkSession, path: str, format: str = "parquet", min_partitions: int = 1, **options: str
) -> DataFrame:
    """Any format, in at least ``min_partitions`` partitions; only a source whose files are split into fewer is shuffled.

    How many splits there are is told by the bytes of the files and the size of a split.
    """
    rows = spark.read.load(path, format, **options)
    if min_partitions <= 1:
        return rows
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    return rows if input_bytes(rows) >= min_partitions * split else rows.repartition(min_partitions)


def read_from_config(spark: SparkSession, config: Mapping, schema: T.StructType) -> DataFrame:
    """Read what a control row describes: ``source_type`` and ``connection_details`` with header and path."""
    details = config["connection_details"]
    reader = spark.read.format(config["source_type"]).schema(schema)
    return reader.option("header", details.get("header", "false")).load(details["path"])


def read_path_sql(spark: SparkSession, path: str, condition: str = "true", format: str = "parquet") -> DataFrame:
    return spark.sql(f"SELECT * FROM {format}.`{path}` WHERE {condition}")


def query_table(spark: SparkSession, table: str, column: str, value) -> DataFrame:
    """Rows of a table given by name whose column equals the value; both are bound, not pasted in."""
    return spark.sql(
        "SELECT * FROM IDENTIFIER(:table_name) WHERE IDENTIFIER(:column) = :value",
        args={"table_name": table, "column": column, "value": value},
    )


def input_bytes(df: DataFrame) -> int:
    """Size of the files behind a file-based DataFrame."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return files.groupBy("path").agg(F.max("bytes").alias("bytes")).agg(F.sum("bytes")).first()[0] or 0


def partitions_for(size: int, target_mb: int = 128) -> int:
    """Partitions of about ``target_mb`` for ``size`` bytes."""
    return max(1, math.ceil(size / (target_mb * 1024 * 1024)))
