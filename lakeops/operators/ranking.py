"""Ranks, n-th highest values, latest rows and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.skew import hot_groups, lookup_join, salted_join
from lakeops.operators.windows import ROWS_IN_ONE_TASK, order_chunks, with_places
from lakeops.session import materialize, parallelism


def nth_highest(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """Rows holding the n-th highest distinct value of their group, ties included. A missing value is lowest.

    Each map task keeps its n highest values per group before anything is shuffled. The first window is
    also split by task, so a value that a third of the rows share is reduced to one row in many tasks
    before the groups are put together.
    """
    pieces = parallelism(df.sparkSession)
    high_first = F.col(value).desc()
    in_piece = Window.partitionBy(*keys, "_piece").orderBy(high_first)
    in_group = Window.partitionBy(*keys).orderBy(high_first)
    wanted = (
        df.select(*keys, value)
        .withColumn("_piece", F.pmod(F.spark_partition_id(), F.lit(pieces)))
        .withColumn("_place", F.dense_rank().over(in_piece))
        .where(F.col("_place") <= n)
        .select(*keys, value)
        .distinct()
        .withColumn("_place", F.dense_rank().over(in_group))
        .where(F.col("_place") == n)
        .drop("_place")
    )
    return lookup_join(df, materialize(wanted, "nth-highest"), [*keys, value], "left_semi", null_safe=True)


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str = "rank",
    hot: dict[int, float] | None = None,
) -> DataFrame:
    """``rank()`` of every row in its group, highest value first, as a bigint.

    Groups too large for one task are cut into chunks, also inside a value that many rows share. Rows are ranked in their
    chunk and stored; a row per chunk then tells how many rows lie above it, and how many of those share its highest
    value. Missing values are lowest.
    """
    hot = hot_groups(df, keys) if hot is None else hot
    if not hot:
        place = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(value).desc()))
        return df.withColumn(name, place.cast("bigint"))
    chunked = order_chunks(with_places(df), [value, "_place"], keys, hot)
    inside = F.rank().over(Window.partitionBy(*keys, "_chunk").orderBy(F.col(value).desc()))
    ranked = materialize(chunked.withColumn("_inside", inside).drop("_tie", "_place"), "ranked-chunks")
    one = F.struct(F.col(value))  # keeps missing values apart from no rows
    per_chunk = (
        ranked.where(F.col("_chunk") != ROWS_IN_ONE_TASK)
        .groupBy(*keys, "_chunk")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.max(one).alias("_top"),
            F.min(one).alias("_bottom"),
            F.max("_inside").alias("_last"),
        )
    )
    downwards = Window.partitionBy(*keys).orderBy(F.col("_chunk").desc())
    same_bottom = Window.partitionBy(*keys, "_bottom").orderBy(F.col("_chunk").desc())
    over = (
        # The rows that share the lowest value of this chunk, from the highest chunk that ends with it.
        per_chunk.withColumn("_run", F.sum(F.col("_rows") - F.col("_last") + 1).over(same_bottom))
        .withColumn("_above", F.coalesce(F.sum("_rows").over(downwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_begun", F.lag("_bottom").over(downwards).eqNullSafe(F.col("_top")))
        .withColumn("_equal", F.when(F.col("_begun"), F.lag("_run").over(downwards)).otherwise(0))
        .select(*keys, "_chunk", "_top", "_above", "_equal")
    )
    # As many rows as there are chunks: a few per task.
    joined = salted_join(ranked, F.broadcast(over), [*keys, "_chunk"], "left", hot={}, null_safe=True)
    shared = one.eqNullSafe(F.col("_top"))
    place = F.coalesce(F.col("_above"), F.lit(0)) + F.when(shared, 1 - F.col("_equal")).otherwise(F.col("_inside"))
    return joined.withColumn(name, place.cast("bigint")).select(*df.columns, name)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``newest_first``, which should end in a tie-breaker.

    Spark keeps one row per key in every map task before the shuffle, so a hot key costs no more than others.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") == 1).drop("_place")


def top_by_count(df: DataFrame, key: str, n: int, count: str = "freq") -> DataFrame:
    """The n most frequent values; equal counts are ordered by the value itself."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.col(count).desc(), F.col(key).asc()).limit(n)


def group_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(value).alias("avg_value"), F.max(value).alias("max_value"), F.min(value).alias("min_value")
    )


def with_bonus(df: DataFrame, value: str, rate: float = 0.1, name: str = "bonus") -> DataFrame:
    return df.withColumn(name, F.col(value) * rate)
