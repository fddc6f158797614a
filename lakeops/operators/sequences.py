"""Gaps, missing values and streaks in dates and integers.

Rows are first reduced to one per key and day, so a window over a key never holds more rows than the
calendar has days, whatever the share of the key in the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import materialize, parallelism

#: Integers of a gap that one row stands for.
BLOCK = 10_000


def key_days(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    return df.select(*keys, F.col(day).cast("date").alias(day)).dropDuplicates()


def date_gaps(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Missing stretches between two consecutive days of a key, as first and last missing day."""
    window = Window.partitionBy(*keys).orderBy(day)
    return (
        key_days(df, keys, day)
        .withColumn("previous_day", F.lag(day, 1).over(window))
        .where(F.datediff(day, "previous_day") > 1)
        .withColumn("missing_from", F.date_add("previous_day", 1))
        .withColumn("missing_to", F.date_sub(day, 1))
    )


def missing_dates(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Every day between a key's first and last that it has no row for, made from its gaps."""
    gaps = date_gaps(df, keys, day)
    return gaps.select(*keys, F.explode(F.sequence("missing_from", "missing_to")).alias(day))


def missing_integers(
    df: DataFrame, column: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Integers of the range that do not occur; the range defaults to the column's own.

    Distinct values are dealt into ranges and stored; each is compared with the one before it, the first of a range with
    the last of the range before. Only what lies between is made, in blocks, so that one wide gap becomes many tasks.
    """
    value = F.col(column).cast("bigint")
    present = df.select(value.alias(column)).where(F.col(column).isNotNull())
    for bound, outside in ((first, -1), (last, 1)):
        if bound is not None:
            present = present.where(F.col(column) >= bound if outside < 0 else F.col(column) <= bound)
    if first is not None and last is not None and first > last:
        return present.limit(0)
    # Just outside a given bound stands an end of the outermost gap.
    ends = [n for n in (None if first is None else first - 1, None if last is None else last + 1) if n is not None]
    spark, tasks = df.sparkSession, parallelism(df.sparkSession)
    for end in ends:
        present = present.union(spark.range(end, end + 1, 1, 1).toDF(column))
    dealt = present.distinct().repartitionByRange(tasks, column).withColumn("_range", F.spark_partition_id())
    stored = materialize(dealt, "distinct-integers")
    edges = stored.groupBy("_range").agg(F.max(column).alias("_max"))
    # A row per range.
    before = edges.select("_range", F.lag("_max").over(Window.orderBy("_range")).alias("_before"))
    previous = F.coalesce(F.lag(column).over(Window.partitionBy("_range").orderBy(column)), F.col("_before"))
    gaps = (
        stored.join(F.broadcast(before), "_range")
        .withColumn("_from", previous + 1)
        .where(F.col("_from") < F.col(column))
        .select("_from", (F.col(column) - 1).alias("_to"))
    )
    blocks = (
        gaps.select(F.explode(F.sequence("_from", "_to", F.lit(BLOCK).cast("bigint"))).alias("_from"), "_to")
        .select("_from", F.least("_to", F.col("_from") + (BLOCK - 1)).alias("_to"))
        .repartition(tasks, "_from")
    )
    return blocks.select(F.explode(F.sequence("_from", "_to")).alias(column))


def streaks(df: DataFrame, keys: Sequence[str], day: str, at_least: int) -> DataFrame:
    """Runs of consecutive days with their length.

    A day minus its running number is the same date all through a run.
    """
    window = Window.partitionBy(*keys).orderBy(day)
    return (
        key_days(df, keys, day)
        .withColumn("_run", F.date_sub(day, F.row_number().over(window)))
        .groupBy(*keys, "_run")
        .agg(
            F.min(day).alias("start_date"),
            F.max(day).alias("end_date"),
            F.count(F.lit(1)).alias("consecutive_days"),
        )
        .where(F.col("consecutive_days") >= at_least)
        .drop("_run")
    )
