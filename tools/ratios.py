"""What the design gains, on the bench tables: each measure beside the plain way of doing the same."""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.merge import merge_upsert
from lakeops.operators.skew import hot_groups, salted_join
from lakeops.plans.quality_rules import rule_rejects, rule_summary
from lakeops.queries.quality import LINE_RULES
from lakeops.session import materialize, work_dir
from lakeops.sources.footers import file_ranges
from lakeops.sources.layout import cluster_by_range
from lakeops.streaming import file_stream


def seconds(action, runs: int = 3) -> float:
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def drained(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def rules(spark: SparkSession, lines: DataFrame) -> dict:
    return {
        "one_scan": seconds(lambda: rule_summary(lines, LINE_RULES, "j", "t").collect()),
        "job_per_rule": seconds(lambda: [rule_rejects(lines, [rule], "j", "t").count() for rule in LINE_RULES]),
    }


def skewed_join(spark: SparkSession, lines: DataFrame) -> dict:
    """A third of the lines has one key; the largest task shows what the slowest executor would do.

    The limits of adaptive execution are lowered to the size of the data.
    """
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    left = lines.withColumn(
        "key", F.when(F.col("l_returnflag") == "R", F.lit(-1).cast("bigint")).otherwise(F.col("l_orderkey"))
    ).select("key", "l_extendedprice")
    aggregate = left.select("key").distinct().withColumn("name", F.concat(F.lit("k"), F.col("key")))
    stored = materialize(aggregate, "ratio-right")
    hot = hot_groups(left, ["key"])

    def largest_task(df: DataFrame) -> int:
        # All columns are used, so that none is pruned and the bytes of a task are those of the join itself.
        used = [F.max(F.xxhash64(*df.columns)), F.count("*").alias("count")]
        return df.groupBy(F.spark_partition_id()).agg(*used).agg(F.max("count")).first()[0]

    for key, value in settings.items():
        spark.conf.set(key, value)
    found = {"hot_key_share": round(max(hot.values()), 3)}
    try:
        for name, adaptive in (("adaptive", "true"), ("plain", "false")):
            spark.conf.set("spark.sql.adaptive.skewJoin.enabled", adaptive)
            for kind, right in (("stored", stored), ("aggregate", aggregate)):
                joined = left.join(right, "key")
                found[f"{name}_{kind}"] = seconds(lambda joined=joined: drained(joined))
                found[f"{name}_{kind}_largest_task"] = largest_task(joined)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        salted = salted_join(left, aggregate, ["key"], hot=hot)
        found["salted"] = seconds(lambda: drained(salted))
        found["salted_largest_task"] = largest_task(salted)
        found["finding_hot_keys"] = seconds(lambda: hot_groups(left, ["key"]))
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return found


def clustered_scan(spark: SparkSession, lines: DataFrame) -> dict:
    """Files whose range of prices meets a filter, of 32, and the time to read them."""
    plain, clustered = work_dir(spark, "ratio-plain"), work_dir(spark, "ratio-clustered")
    lines.repartition(32).write.parquet(plain)
    cluster_by_range(lines, "l_extendedprice", 32).write.parquet(clustered)
    low, high = 50000.0, 51000.0
    found = {}
    for name, path in (("unclustered", plain), ("clustered", clustered)):
        spans = file_ranges(spark, path, ["l_extendedprice"])
        meets = (F.col("min_value").cast("double") <= high) & (F.col("max_value").cast("double") >= low)
        found[f"{name}_files"] = spans.where(meets).select("file").distinct().count()
        rows = spark.read.parquet(path).where(F.col("l_extendedprice").between(low, high))
        found[name] = seconds(lambda rows=rows: drained(rows))
    return found


def upsert(spark: SparkSession, orders: DataFrame) -> dict:
    changes = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    took = seconds(lambda: drained(merge_upsert(orders, changes, ["o_orderkey"])))
    return {"seconds": took, "target_rows_per_second": round(orders.count() / took)}


def second_ingest(spark: SparkSession, events: DataFrame) -> dict:
    base = work_dir(spark, "ratio-stream")
    events.repartition(8).write.parquet(f"{base}/landed")
    taken = []
    for _ in range(2):
        stream = file_stream.file_stream(spark, f"{base}/landed", events.schema)
        query = file_stream.drain(stream, f"{base}/sink", f"{base}/checkpoint")
        taken.append(sum(progress["numInputRows"] for progress in query.recentProgress))
    return {"first_run_rows": taken[0], "second_run_rows": taken[1]}


def measure(spark: SparkSession, sf: str) -> dict:
    lines, orders, events = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("lineitem", "orders", "events"))
    # The table is a single file; a copy in several can be read by several tasks.
    copy = work_dir(spark, "ratio-lines")
    lines.repartition(16).write.parquet(copy)
    lines = spark.read.parquet(copy)
    return {
        "rules": rules(spark, lines),
        "skewed_join": skewed_join(spark, lines),
        "clustered_scan": clustered_scan(spark, lines),
        "upsert": upsert(spark, orders),
        "second_ingest": second_ingest(spark, events),
    }
