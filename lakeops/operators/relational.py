"""Lookups, balances and filling of missing numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.skew import lookup_join


def enrich(df: DataFrame, *lookups: tuple[DataFrame, str]) -> DataFrame:
    """Left-join lookup tables one after the other, each on its key column; lookup keys should be unique."""
    joined = df
    for table, key in lookups:
        joined = lookup_join(joined, table, [key], "left")
    return joined


def final_balances(
    balances: DataFrame, balance: str, transactions: DataFrame, amount: str, is_credit: Column, key: str
) -> DataFrame:
    """Balance plus credits minus debits; keys without transactions keep their balance."""
    signed = F.when(is_credit, F.col(amount)).otherwise(-F.col(amount))
    net = transactions.groupBy(key).agg(F.sum(signed).alias("net"))
    joined = balances.join(net, key, "left").withColumn("net", F.coalesce("net", F.lit(0)))
    return joined.withColumn("final_balance", F.col(balance) + F.col("net"))


def mean_fill(df: DataFrame, columns: Sequence[str] | None = None, keep_type: bool = False) -> DataFrame:
    """Fill missing numbers with their column's mean; all means come from one pass.

    Whole-number columns become double so that the mean is kept, unless ``keep_type`` asks for it to be cut.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    columns = [c for c in (columns or numeric) if c in numeric]
    if not columns:
        return df
    if not keep_type:
        df = df.withColumns({c: F.col(c).cast("double") for c in columns})
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    known = {c: m for c, m in means.items() if m is not None}
    return df.fillna(known) if known else df


def present_columns(df: DataFrame, wanted: Sequence[str], add_missing: bool = False) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order; optionally add the others as null."""
    if add_missing:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in wanted])
    return df.select(*[c for c in wanted if c in df.columns])
