"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.sources.readers import read_with_floor

#: Tables whose rows take long to work on.
TEXTS = ("documents", "pages", "conversations")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. One of texts with fewer files than cores is dealt over the cores, if its bytes are few, too."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    rows, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    if name not in TEXTS or len(rows.inputFiles()) >= cores:
        return rows
    return read_with_floor(spark, path, min_partitions=cores)
