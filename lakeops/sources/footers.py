"""What the files of a dataset hold: rows, missing values and range of each column per file, and files that overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.operators.windows import order_chunks
from lakeops.session import materialize


def file_ranges(spark: SparkSession, path: str, columns: Sequence[str], format: str = "parquet") -> DataFrame:
    """A row per file and column: ``file``, ``bytes``, ``rows``, ``column``, ``nulls``, ``min_value`` and ``max_value``.

    One scan of these columns, added up by file in the tasks that read it; bounds are shown as text. Files without rows
    have none here either.
    """
    rows = spark.read.format(format).load(path)
    source = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    facts = [
        F.struct(
            F.lit(name).alias("column"),
            F.count_if(F.col(f"`{name}`").isNull()).alias("nulls"),
            F.min(f"`{name}`").cast("string").alias("min_value"),
            F.max(f"`{name}`").cast("string").alias("max_value"),
        )
        for name in columns
    ]
    per_file = rows.select(*source, *[f"`{name}`" for name in columns]).groupBy("file", "bytes")
    told = per_file.agg(F.count(F.lit(1)).alias("rows"), F.array(*facts).alias("facts"))
    return told.select("file", "bytes", "rows", F.inline("facts"))


def range_overlaps(ranges: DataFrame, column: str) -> DataFrame:
    """Files in the order of their smallest value, with whether each begins below an earlier file's largest.

    Files are cut into chunks of that order; a chunk's files are compared with each other and with the largest value of
    all chunks before it. Files without values of the column are left out.
    """
    found = ranges.where((F.col("column") == column) & F.col("min_value").isNotNull())
    low, high = F.col("min_value").cast("double").alias("low"), F.col("max_value").cast("double").alias("high")
    spans = materialize(found.select("file", low, high), "file-spans")
    order = ["low", "high", "file"]
    chunked = order_chunks(spans, order)
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # A row per chunk.
    largest = chunked.groupBy("_chunk").agg(F.max("high").alias("_high")).withColumn("_before", F.max("_high").over(before))
    inside = F.max("high").over(Window.partitionBy("_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    joined = chunked.withColumn("_inside", inside).join(F.broadcast(largest.select("_chunk", "_before")), "_chunk")
    overlaps = F.coalesce(F.col("low") < F.greatest("_inside", "_before"), F.lit(False))
    return joined.select("file", "low", "high", overlaps.alias("overlaps"))
