"""File layouts that let a filter skip files, and files of the right size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize

#: Sampled rows per bucket of a Z-curve.
SAMPLED = 200


def in_files(df: DataFrame, files: int) -> DataFrame:
    """A scan in ``files`` partitions; merging partitions needs no shuffle, only splitting them does."""
    return df.coalesce(files) if df.rdd.getNumPartitions() >= files else df.repartition(files)


def _along(df: DataFrame, curve: Sequence[str], files: int) -> DataFrame:
    """Range-partition and sort; rows that share a place are spread, so a frequent value fills many files."""
    # Maps have no hash; the partition and the other columns spread rows that differ in maps only.
    hashed = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.xxhash64(F.spark_partition_id(), *hashed)
    placed = df.withColumn("_spread", spread).repartitionByRange(files, *curve, "_spread")
    return placed.drop("_spread").sortWithinPartitions(*curve)


def cluster_by_range(df: DataFrame, column: str, files: int) -> DataFrame:
    """Rows placed so that every file holds its own range of ``column``."""
    return _along(df, [column], files)


def places(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """One row with a sorted array of up to ``buckets - 1`` cutting points for each column, of any type that has an order.

    The points come from a random sample of about ``SAMPLED`` rows a bucket, so they fit one row whatever the table's size;
    they decide how even the buckets are, never a result. Missing values have no point.
    """
    rows = max(1, df.count())
    sample = df.select(*columns).where(F.rand(11) < min(1.0, SAMPLED * buckets / rows))
    sorted_values = sample.agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in columns])

    def cut(name: str) -> Column:
        values, steps = F.col(name), F.sequence(F.lit(1), F.lit(buckets - 1))
        at = F.transform(steps, lambda i: F.floor(i * F.size(values) / buckets).cast("int"))
        return F.array_distinct(F.filter(F.transform(at, lambda i: F.get(values, i)), lambda v: v.isNotNull()))

    return sorted_values.select(*[cut(name).alias(name) for name in columns])


def cluster_by_zorder(df: DataFrame, columns: Sequence[str], files: int, bits: int = 6) -> DataFrame:
    """Rows placed along a Z-curve, so that files are narrow in all of ``columns``, which may be texts, too.

    Each column is cut into 2**bits buckets of about equal size, a missing value lying in the first, and the buckets' bits
    are interleaved.
    """
    # Stored, so that the sample is taken once: a row with a few points.
    marks = materialize(places(df, columns, 2**bits), "zorder-marks").select(
        *[F.col(c).alias(f"_marks{i}") for i, c in enumerate(columns)]
    )
    bucketed = df.crossJoin(F.broadcast(marks)).withColumns({f"_bucket{i}": F.lit(0) for i in range(len(columns))})
    # The sorted marks are halved, a projection a step. Beyond the last mark and for a missing value the comparison is
    # null and nothing is added.
    for bit in reversed(range(bits)):
        step = 1 << bit
        bucketed = bucketed.withColumns(
            {
                f"_bucket{i}": F.when(
                    F.get(F.col(f"_marks{i}"), F.col(f"_bucket{i}") + (step - 1)) <= F.col(c), F.col(f"_bucket{i}") + step
                ).otherwise(F.col(f"_bucket{i}"))
                for i, c in enumerate(columns)
            }
        )
    bucketed = bucketed.withColumns({f"_bucket{i}": F.col(f"_bucket{i}").cast("bigint") for i in range(len(columns))})
    curve = F.lit(0).cast("bigint")
    for place in range(len(columns)):
        for bit in range(bits):
            one = F.shiftright(f"_bucket{place}", bit).bitwiseAND(F.lit(1).cast("bigint"))
            curve = curve.bitwiseOR(F.shiftleft(one, bit * len(columns) + place))
    own = [f"_{kind}{i}" for kind in ("marks", "bucket") for i in range(len(columns))]
    return _along(bucketed.withColumn("_curve", curve).drop(*own), ["_curve"], files).drop("_curve")

