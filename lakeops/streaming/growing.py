"""Incremental ingest of files whose columns change from one file to the next.

A stream of file names tells which files are new; a batch of them is read with the columns that the files themselves have.
The schema of the sink is the union of all columns met so far, each with the type it had first. A value of another type is
converted if it comes back unchanged, and otherwise kept as JSON in a column of rescued data, so nothing is dropped.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.session import one_row, path_exists

RESCUED = "_rescued_data"
#: Fixed value: what Spark calls files whose columns of one name have types that do not go together.
CONFLICT = "CANNOT_MERGE_SCHEMAS"
FILE_NAMES = "path string, modificationTime timestamp, length bigint, content binary"


def known_schema(spark: SparkSession, schema_path: str) -> T.StructType:
    """The columns met so far; none before the first run."""
    if not path_exists(spark, schema_path):
        return T.StructType([])
    newest = spark.read.schema("number int, schema string").json(schema_path).agg(F.max_by("schema", "number")).first()[0]
    return T.StructType.fromJson(json.loads(newest)) if newest else T.StructType([])


def grown(known: T.StructType, *found: T.StructType) -> T.StructType:
    """``known`` with the columns that only ``found`` have behind it; names are not case-sensitive."""
    fields = {field.name.lower(): field for field in known}
    for schema in found:
        for field in schema:
            fields.setdefault(field.name.lower(), T.StructField(field.name, field.dataType, True))
    return T.StructType(list(fields.values()))


def read_alike(spark: SparkSession, paths: list[str], source: str, format: str, **options: str) -> list[DataFrame]:
    """The files in as few groups as there have to be for the columns of a group to go together.

    Spark merges the columns of all files in one job. Where it cannot, the files are halved until it can, so a few odd
    files among many cost a few more jobs.
    """
    reader = spark.read.format(format).options(**{"mergeSchema": "true", **options, "basePath": source})
    try:
        return [reader.load([_literal(path) for path in paths])]
    except (PySparkException, Py4JJavaError) as error:  # the second where a stream hands a batch over
        if len(paths) == 1 or CONFLICT not in str(error):
            raise
    middle = len(paths) // 2
    return [
        df for part in (paths[:middle], paths[middle:]) for df in read_alike(spark, part, source, format, **options)
    ]


def _literal(path: str) -> str:
    """A path in which nothing stands for other characters."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def _plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType, T.NullType))


def fitted(df: DataFrame, schema: T.StructType, rescued: str = RESCUED) -> DataFrame:
    """``df`` with exactly the columns of ``schema`` and one of rescued data, which is null where all values fit."""
    own = {field.name.lower(): field for field in df.schema}
    columns: list[Column] = []
    misfits: list[Column] = []
    for field in schema:
        found = own.get(field.name.lower())
        if found is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{found.name}`")
        if found.dataType == field.dataType:
            columns.append(value.alias(field.name))
            continue
        if _plain(found.dataType) and _plain(field.dataType):
            taken = value.try_cast(field.dataType)
            fits = taken.try_cast(found.dataType).eqNullSafe(value)
        else:
            taken, fits = F.lit(None).cast(field.dataType), value.isNull()
        columns.append(F.when(fits, taken).alias(field.name))
        misfits.append(F.when(~fits, value).alias(field.name))
    kept = F.nullif(F.to_json(F.struct(*misfits)), F.lit("{}")) if misfits else F.lit(None).cast("string")
    return df.select(*columns, kept.alias(rescued))


def drain_growing(
    spark: SparkSession,
    source: str,
    sink: str,
    schema_path: str,
    checkpoint: str,
    format: str = "parquet",
    rescued: str = RESCUED,
    max_files_per_batch: int = 10_000,
    **options: str,
) -> StreamingQuery:
    """Append all files not yet taken in to ``sink``, a folder per batch; returns the finished query.

    A batch handed over again, as after a crash, writes its own folder anew. ``options`` are those of the reader.
    """

    def handle(batch: DataFrame, number: int) -> None:
        # The stream itself lists these names on the driver.
        paths = sorted(row["path"] for row in batch.collect())
        if not paths:
            return
        parts = read_alike(spark, paths, source, format, **options)
        known = known_schema(spark, schema_path)
        schema = grown(known, *[part.schema for part in parts])
        if rescued.lower() in {name.lower() for name in schema.names}:
            raise ValueError(f"the files have a column {rescued!r}; give the rescued data another name")
        rows = fitted(parts[0], schema, rescued)
        for part in parts[1:]:
            rows = rows.unionByName(fitted(part, schema, rescued))
        if schema != known:
            row = one_row(spark, {"number": number, "schema": schema.json()}, "number int, schema string")
            row.write.mode("append").json(schema_path)
        rows.write.mode("overwrite").parquet(f"{sink}/_batch={number}")

    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_NAMES)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(source)
        .select("path")
    )
    query = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_grown(spark: SparkSession, sink: str, schema_path: str, rescued: str = RESCUED) -> DataFrame:
    """All rows taken in so far, with all columns met so far; rows from before a column came have none there."""
    schema = T.StructType([*known_schema(spark, schema_path), T.StructField(rescued, T.StringType())])
    return spark.read.schema(schema).parquet(sink).select(*[f"`{name}`" for name in schema.names])
