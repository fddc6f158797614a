"""Ordered windows over rows, cut into chunks where a group is too large for one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from lakeops.functions.change import percent_change
from lakeops.operators.skew import group_hash, hot_groups
from lakeops.session import materialize, parallelism

ROWS_IN_ONE_TASK = -1  # chunk number of groups that need no cutting


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed, which puts rows that an order leaves equal in one defined order."""
    return F.xxhash64(*[name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def with_places(df: DataFrame) -> DataFrame:
    """``df`` with ``_tie`` (a hash of the row) and ``_place`` (where it lies).

    Behind other order columns they make the order total, so that cuts can lie inside rows that are all alike. Only
    what :func:`order_chunks` stores of it has fixed places.
    """
    return df.withColumns({"_tie": row_hash(df), "_place": F.monotonically_increasing_id()})


def _group(keys: Sequence[str]) -> Column:
    return group_hash(keys) if keys else F.lit(0).cast("bigint")


def order_chunks(
    df: DataFrame, order: str | Sequence[str], keys: Sequence[str] = (), hot: dict[int, float] | None = None
) -> DataFrame:
    """Add ``_chunk``, which rises with all columns of ``order`` inside each hot key group and is -1 in the others.

    Without ``keys`` all rows are one group. Rows that are equal in all of ``order`` share a chunk, so a group is cut
    inside any value of its first columns. Rows are dealt into ranges of the group and the order, each about half a task's
    share, by Spark's range partitioning, and stored, so that every reader of the chunks sees the same cuts.
    """
    columns = order_columns(order)
    if not keys:
        hot = {0: 1.0}
    elif hot is None:
        hot = hot_groups(df, keys)
    if not hot:
        return df.withColumn("_chunk", F.lit(ROWS_IN_ONE_TASK))
    is_hot = _group(keys).isin(list(hot))
    dealt = df.repartitionByRange(2 * parallelism(df.sparkSession), F.when(is_hot, _group(keys)), *columns)
    chunk = F.when(is_hot, F.spark_partition_id()).otherwise(ROWS_IN_ONE_TASK)
    return materialize(dealt.withColumn("_chunk", chunk), "chunks")


def order_columns(order: str | Sequence[str]) -> list[str]:
    """The first column orders rows, the others break its ties."""
    return [order] if isinstance(order, str) else list(order)


def carry_rows(chunked: DataFrame, order: str | Sequence[str], keys: Sequence[str], before: int = 0, after: int = 0) -> DataFrame:
    """Copy the rows next to each chunk's edges into it, marked ``_carried``.

    With them a frame of up to ``before`` rows back and ``after`` rows ahead can be computed inside a
    chunk. At most ``before + after`` rows of a chunk are copied.
    """
    columns = order_columns(order)
    cut = chunked.where(F.col("_chunk") != ROWS_IN_ONE_TASK)
    result = chunked.withColumn("_carried", F.lit(False))
    for rows, inside, neighbour in (
        (before, [F.col(c).desc() for c in columns], F.lead),
        (after, [F.col(c).asc() for c in columns], F.lag),
    ):
        if not rows:
            continue
        edge = Window.partitionBy(*keys, "_chunk").orderBy(*inside)
        # One hot group's edges: `rows` times its number of chunks.
        edges = Window.partitionBy(*keys).orderBy("_chunk", *columns)
        copies = (
            cut.withColumn("_from_edge", F.row_number().over(edge))
            .where(F.col("_from_edge") <= rows)
            .withColumn("_goes", F.array(*[neighbour("_chunk", i).over(edges) for i in range(1, rows + 1)]))
            .withColumn("_goes", F.explode(F.array_distinct("_goes")))
            .where(F.col("_goes") != F.col("_chunk"))
            .withColumn("_chunk", F.col("_goes"))
            .withColumn("_carried", F.lit(True))
            .drop("_from_edge", "_goes")
        )
        result = result.unionByName(copies)
    return result


def over_rows(
    df: DataFrame,
    order: str | Sequence[str],
    columns: dict[str, Callable[[WindowSpec], Column]],
    keys: Sequence[str] = (),
    back: int = 0,
    ahead: int = 0,
    bounded: bool = False,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows back and ``ahead`` rows ahead.

    ``order`` is a column or several, of which the later break ties of the earlier; rows that are equal in all of them
    follow a hash of the row, and rows that are equal altogether may stand in any order. ``bounded`` says that groups are
    known to be small, as after an aggregation by calendar day; otherwise a large group is cut into chunks anywhere in that
    order, and the rows are stored with them.
    """
    by = order_columns(order)
    hot = {} if bounded else {0: 1.0} if not keys else hot_groups(df, keys)
    if not hot:
        window = Window.partitionBy(*keys).orderBy(*by, row_hash(df))
        return df.withColumns({name: build(window) for name, build in columns.items()})
    by = [*by, "_tie", "_place"]
    chunked = carry_rows(order_chunks(with_places(df), by, keys, hot), by, keys, back, ahead)
    window = Window.partitionBy(*keys, "_chunk").orderBy(*by)
    result = chunked.withColumns({name: build(window) for name, build in columns.items()})
    return result.where(~F.col("_carried")).drop("_chunk", "_carried", "_tie", "_place")


def lag_lead(
    df: DataFrame,
    order: str | Sequence[str],
    value: str,
    keys: Sequence[str] = (),
    previous: str = "previous",
    following: str = "following",
    bounded: bool = False,
) -> DataFrame:
    columns = {
        previous: lambda window: F.lag(value, 1).over(window),
        following: lambda window: F.lead(value, 1).over(window),
    }
    return over_rows(df, order, columns, keys, back=1, ahead=1, bounded=bounded)


def period_gap(
    df: DataFrame, order: str | Sequence[str], value: str, keys: Sequence[str] = (), gap: str = "gap_pct", bounded: bool = False
) -> DataFrame:
    """Previous and following value, and the change from the previous one relative to the current one."""
    rows = lag_lead(df, order, value, keys, bounded=bounded)
    return rows.withColumn(gap, percent_change(F.col(value), F.col("previous")))


def moving_average(
    df: DataFrame,
    order: str | Sequence[str],
    value: str,
    keys: Sequence[str] = (),
    rows: int = 3,
    name: str = "moving_avg",
    bounded: bool = False,
) -> DataFrame:
    """Average of the current and the ``rows - 1`` preceding values."""
    columns = {name: lambda window: F.avg(value).over(window.rowsBetween(1 - rows, 0))}
    return over_rows(df, order, columns, keys, back=rows - 1, bounded=bounded)


def year_over_year(df: DataFrame, year: str, value: Column) -> DataFrame:
    """Total of all rows per year and its change against the year before it in the data.

    Equal rows count each; where a file may hold rows twice, drop those before. The window has one row per year, so a
    single task for it is enough at any size of ``df``.
    """
    yearly = df.groupBy(year).agg(F.sum(value).alias("total"))
    window = Window.orderBy(year)
    return yearly.withColumn("previous_total", F.lag("total").over(window)).withColumn(
        "change_pct", F.round(percent_change(F.col("total"), F.col("previous_total"), base="previous"), 2)
    )
