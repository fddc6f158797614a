"""Repeated rows and undirected pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.skew import salted_join


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def rows_with_repeated_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    return salted_join(df, repeated_keys(df, keys).select(*keys), keys, "left_semi")


def undirected_pairs(df: DataFrame, source: str, destination: str) -> DataFrame:
    """One row per pair, A-B being the same as B-A: the row with the smaller source.

    A missing end is an end like others and the smallest of all. The smaller row is found in every map task before the
    shuffle.
    """
    ends = F.sort_array(F.array(source, destination))
    return (
        df.groupBy(ends[0].alias("_low"), ends[1].alias("_high"))
        .agg(F.min(F.struct(F.col(source).alias("source"), F.col(destination).alias("destination"))).alias("_row"))
        .select(F.col("_row.source").alias(source), F.col("_row.destination").alias(destination))
    )
