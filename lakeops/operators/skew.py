"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize, parallelism

# No more than 1 / SMALLEST_SHARE groups can be hot, so the list of them always fits on the driver.
SMALLEST_SHARE = 1 / 100_000
# The most that a sketch may track.
SKETCH_ITEMS = 1_000_000
# Sketches are merged in this many tasks first, then in one.
MERGE_TASKS = 256

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

REPLICABLE_JOINS = ("inner", "left", "left_semi", "left_anti")


def group_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_groups(df: DataFrame, keys: Sequence[str], share: float | None = None) -> dict[int, float]:
    """Hash of every key group above ``share`` of the rows, with its share.

    One pass over the key columns into a frequent-items sketch; nothing but sketches is shuffled. Run
    once and used as literals, so both sides of a join treat the same keys as hot even if tasks are redone.
    The default share is what one shuffle task should hold.
    """
    if share is None:
        share = max(SMALLEST_SHARE, 1 / parallelism(df.sparkSession))
    if share < SMALLEST_SHARE:
        raise ValueError(f"a share below {SMALLEST_SHARE} cannot be told by a sketch")
    # A sketch's error, 3.5 / 2 of a tracked item's part of the rows, stays below a quarter of the share.
    items = min(SKETCH_ITEMS, max(8192, math.ceil(8 / share)))
    sketches = (
        df.select(group_hash(keys).alias("item"), F.pmod(F.spark_partition_id(), F.lit(MERGE_TASKS)).alias("task"))
        .groupBy("task")
        .agg(
            F.expr(f"approx_top_k_accumulate(item, {items})").alias("sketch"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    top = (
        # Grouped by a constant, because no rows must give no group.
        sketches.groupBy(F.lit("all"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch"), F.sum("rows").alias("rows"))
        .selectExpr("rows", f"explode(approx_top_k_estimate(sketch, {math.ceil(1 / share)})) as top")
        .selectExpr("top.item as item", "top.count / rows as share")
        .where(F.col("share") > share)
    )
    return {row["item"]: row["share"] for row in top.collect()}


def _pieces(keys: Sequence[str], hot: dict[int, float], tasks: int) -> Column:
    """How many pieces the rows of a key are cut into: by the share of that key, rounded up to a power of two.

    A piece is at most half a task's fair share, because some tasks get two pieces. There are few powers of two, so the
    expression stays short however many keys are hot.
    """
    levels: dict[int, list[int]] = {}
    for item, share in hot.items():
        levels.setdefault(2 ** math.ceil(math.log2(max(2, 2 * share * tasks))), []).append(item)
    pieces = F.lit(1)
    for count, items in levels.items():
        pieces = F.when(group_hash(keys).isin(items), F.lit(count)).otherwise(pieces)
    return pieces


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: dict[int, float] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join in which rows of hot left keys are spread over several tasks.

    For sides that Spark cannot split by itself, as where an aggregate lies between shuffle and join; plain scans and
    stored sides are better left to adaptive execution. The right rows of a hot key are copied once per piece that the
    key needs, those of other keys are not; without hot keys this is a plain join. A row's salt is a hash of its values and its partition number: a redone task
    computes it again unchanged in whatever order its rows arrive, and identical rows are spread by where
    they are. It takes in all columns of ``left``, so select the ones needed before.
    """
    if how not in REPLICABLE_JOINS:
        raise ValueError(f"a salted join cannot be {how!r}: copied right rows would show in the result")
    for key in on:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise ValueError(f"cast {key!r} to one type on both sides first")
    hot = hot_groups(left, on) if hot is None else hot
    keys = list(on)
    if hot:
        pieces = _pieces(on, hot, parallelism(left.sparkSession))
        values = [name for name, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
        salt = F.pmod(F.xxhash64(F.spark_partition_id(), *values), pieces).cast("int")
        left = left.withColumn("_salt", salt)
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
        keys.append("_salt")
    if null_safe:
        renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
        same = reduce(Column.__and__, [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys])
        joined = left.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])
    else:
        joined = left.join(right, keys, how)
    return joined.drop("_salt")


def _cells(left_rows: float, right_rows: float, cells: int) -> tuple[int, int]:
    """How many pieces each side of a key is cut into, so that there are ``cells`` pairs of them and the fewest copies.

    Every piece of one side meets every piece of the other, so left rows are copied as often as there are right pieces.
    Both numbers are powers of two; the copies are fewest where pieces of both sides are alike in size.
    """
    steps = max(0, math.ceil(math.log2(cells)))
    left = round((steps + math.log2(left_rows / right_rows)) / 2)
    left = min(max(left, 0), steps)
    return 2**left, 2 ** (steps - left)


def grid_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", pairs: str | None = None
) -> DataFrame:
    """Equi-join for keys that may hold a large part of the rows on both sides.

    The rows of such a key are cut on both sides, and each pair of pieces is a cell of its own: left rows are dealt over
    the rows of that grid and copied along them, right rows over its columns. A key that is hot on one side only is cut
    there, others are not. Hot keys, and how they are cut, come from a sketch and a count of each side.

    A left join takes keys that are hot on both sides apart, as their rows all find partners: the others are joined
    without copies of left rows. Semi and anti joins look at the distinct keys of the right side.

    With ``pairs``, rows of a side that are alike in all columns are joined as one, and the column of that name says how
    many rows of the plain join a row stands for. Their number is the product of both sides' copies, so select only the
    columns that are needed before: what is then counted or added up per key grows with the kinds of rows, not their pairs.
    """
    if how not in REPLICABLE_JOINS:
        raise ValueError(f"a grid join cannot be {how!r}: copied rows would show in the result")
    if pairs is not None:
        sides = zip((left, right), ("_left_copies", "_right_copies"))
        kinds = [materialize(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n)), "kinds") for df, n in sides]
        joined = grid_join(*kinds, on, how)
        # A left row without a partner is one row; semi and anti joins have left rows only.
        right_copies = F.coalesce("_right_copies", F.lit(1)) if how in ("inner", "left") else F.lit(1)
        return joined.withColumn(pairs, F.col("_left_copies") * right_copies).drop("_left_copies", "_right_copies")
    if how in ("left_semi", "left_anti"):
        return salted_join(left, right.select(*on).distinct(), on, how)
    left_hot, right_hot = hot_groups(left, on), hot_groups(right, on)
    both = left_hot.keys() & right_hot.keys()
    if how == "left":
        one_sided = {key: share for key, share in left_hot.items() if key not in both}
        if not both:
            return salted_join(left, right, on, "left", one_sided)
        # A missing key matches nothing, however hot.
        present = reduce(Column.__and__, [F.col(key).isNotNull() for key in on])
        apart = group_hash(on).isin(list(both)) & present
        rest = salted_join(left.where(~apart), right.where(~apart), on, "left", one_sided)
        return grid_join(left.where(apart), right.where(apart), on).unionByName(rest)
    if not left_hot and not right_hot:
        return left.join(right, list(on), how)
    tasks = parallelism(left.sparkSession)
    left_rows, right_rows = left.count(), right.count()
    levels: dict[tuple[int, int], list[int]] = {}
    for key in left_hot.keys() | right_hot.keys():
        # Pairs of a key that is hot on both sides are most of the work, so it alone fills all tasks.
        share = 1.0 if key in both else max(left_hot.get(key, 0), right_hot.get(key, 0))
        sizes = max(1, left_hot.get(key, 0) * left_rows), max(1, right_hot.get(key, 0) * right_rows)
        levels.setdefault(_cells(*sizes, max(2, math.ceil(2 * share * tasks))), []).append(key)

    def pieces(side: int) -> Column:
        count = F.lit(1)
        for cut, items in levels.items():
            count = F.when(group_hash(on).isin(items), F.lit(cut[side])).otherwise(count)
        return count

    def dealt(df: DataFrame, own: str, other: str, side: int) -> DataFrame:
        values = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
        place = F.pmod(F.xxhash64(F.spark_partition_id(), *values), pieces(side)).cast("int")
        placed = df.withColumn(own, place)
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), pieces(1 - side) - 1)))

    cells = ["_grid_row", "_grid_column"]
    joined = dealt(left, *cells, 0).join(dealt(right, *cells[::-1], 1), [*on, *cells], "inner")
    return joined.drop(*cells)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure whether ``df`` is small enough to send to every executor.

    Rows are counted first, which reads next to nothing; only a side of few rows has its bytes added up.
    """
    rows = df.count()
    return rows <= max_rows and _bytes(df, rows) <= max_bytes


def _bytes(df: DataFrame, rows: int) -> int:
    fixed = {"tinyint": 1, "smallint": 2, "int": 4, "boolean": 1, "float": 4}
    size, varying = 0, []
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            varying.append(F.sum(F.octet_length(name)))
        elif kind.startswith(("array", "map", "struct", "variant")):
            varying.append(F.sum(F.octet_length(F.to_json(F.struct(name)))))
        else:
            size += fixed.get(kind, 16) * rows
    return size + sum(total or 0 for total in df.agg(*varying).first()) if varying else size


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join a large table to a side that is usually small: broadcast if measured small.

    A larger side is stored and joined by a shuffle that adaptive execution splits where a key is hot.
    """
    if fits_broadcast(right):
        # Nothing of the left side moves, so hot keys do not matter.
        return salted_join(left, F.broadcast(right), on, how, hot={}, null_safe=null_safe)
    return salted_join(left, materialize(right, "lookup"), on, how, hot={}, null_safe=null_safe)


def lookup_join_on(left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str = "inner") -> DataFrame:
    """Like :func:`lookup_join` for differently named keys; both key copies stay in the result."""
    named = right.select("*", *[F.col(other).alias(name) for name, other in pairs.items()])
    return lookup_join(left, named, list(pairs), how)
