"""Incremental ingest of files: each run takes in what has arrived since the last one, then stops."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.merge import require_unique
from lakeops.session import one_row, path_exists
from lakeops.sources.snapshots import VersionedTable


def stream_schema(spark: SparkSession, source: str, schema_path: str, format: str = "parquet") -> T.StructType:
    """Schema of the stream: inferred from the files the first time, read from ``schema_path`` afterwards.

    It stays as it was then, so columns that later files bring are not read; for those see ``growing``.
    """
    if path_exists(spark, schema_path):
        saved = spark.read.text(schema_path).first()
        return T.StructType.fromJson(json.loads(saved["value"]))
    schema = spark.read.format(format).load(source).schema
    one_row(spark, {"value": schema.json()}, "value string").write.mode("overwrite").text(schema_path)
    return schema


def file_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    format: str = "parquet",
    max_files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(format).schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(source)


def drain(stream: DataFrame, sink: str, checkpoint: str, format: str = "parquet") -> StreamingQuery:
    """Append all files not yet taken in to ``sink``; returns the finished query with its progress.

    The checkpoint remembers the files, and the sink's own log makes each batch count once.
    """
    query = (
        stream.writeStream.format(format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
    return _finish(query)


def drain_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Like :func:`drain` with a function that is given each batch and its number."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return _finish(query)


def upsert_into(table: VersionedTable, keys: list[str], stream: str = "stream") -> Callable[[DataFrame, int], None]:
    """Batch handler that merges into a versioned table.

    The commit carries the stream's name and the batch number, so a batch handed over again is left out.
    """

    def handle(batch: DataFrame, number: int) -> None:
        tag = f"{stream}:{number}"
        if table.has_commit(tag):
            return
        if table.current_version() is None:
            require_unique(batch, keys)
            table.overwrite(batch, tag=tag)
        else:
            table.merge(batch, keys, tag=tag)

    return handle


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query
