"""Session settings and the shared work folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "lakeops", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults.

    Size ``spark.sql.shuffle.partitions`` for the cluster (a few per core, or input bytes / 128 MB);
    adaptive execution merges the small ones, and the skew operators use it as the task count to split for.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def parallelism(spark: SparkSession) -> int:
    """Number of reduce tasks a shuffle is planned for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder given by ``spark.checkpoint.dir``, else under the warehouse.

    All folders of an application lie in one, which is deleted when the application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    home = f"{base.rstrip('/')}/lakeops/{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(home)
    # It has to exist to be noted for deletion; noting it again changes nothing.
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{home}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives lost executors, is computed once however often it is used, and lets Spark plan
    with its true size.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(spark: SparkSession, values: Mapping, schema: str) -> DataFrame:
    """A row made by Spark itself from plain values, such as a log entry; fields left out are null."""
    text = json.dumps(values, default=lambda value: value.isoformat())
    row = F.from_json(F.lit(text), schema, {"mode": "FAILFAST"}).alias("row")
    return spark.range(0, 1, 1, 1).select(row).select("row.*")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists in whatever file system it belongs to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
