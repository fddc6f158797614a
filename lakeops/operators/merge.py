"""Upserts, updates, deletes, change feeds and slowly changing dimensions, as DataFrame to DataFrame.

The target is taken to be large and the incoming rows usually few. Each operator passes over the target
without shuffling it when the incoming side is measured small, and salts the join when it is not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.predicates import all_present, true_only
from lakeops.operators.skew import BROADCAST_ROWS, fits_broadcast, hot_groups, lookup_join, salted_join
from lakeops.session import materialize


def require_unique(df: DataFrame, keys: Sequence[str]) -> int:
    """Raise if a complete key occurs twice; returns the number of complete keys."""
    per_key = df.where(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    most, total = per_key.agg(F.max("rows"), F.count(F.lit(1))).first()
    if (most or 0) > 1:
        raise ValueError(f"several rows have the same key {list(keys)}")
    return total


def _combine(target: DataFrame, source: DataFrame, keys: Sequence[str], stored: bool, pick) -> DataFrame:
    """Target rows with ``pick(column, matched, new value)`` applied, and source rows with a new key.

    Missing keys match nothing: such target rows stay and such source rows are added. The source is used
    several times, so unless it is ``stored`` in files already it is worked out once and written first.
    """
    absent = [c for c in target.columns if c not in source.columns]
    if absent:
        raise ValueError(f"the source lacks the columns {absent}")
    others = [c for c in target.columns if c not in keys]
    source = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    if not stored:
        source = materialize(source, "merge-source")
    incoming = source.where(all_present(keys)).select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in others], F.lit(True).alias("_matched")
    )
    small = require_unique(source, keys) <= BROADCAST_ROWS and fits_broadcast(incoming)
    matched = F.col("_matched").isNotNull()
    hot = {} if small else hot_groups(target, keys)
    if not small and not hot:
        # One pass over the target and one shuffle of each side; missing keys match nothing in an outer join either.
        new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in others], F.lit(True).alias("_matched"))
        old = target.withColumn("_there", F.lit(True)).alias("old")
        same = reduce(Column.__and__, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
        both, there = old.join(new.alias("new"), same, "full"), F.col("_there").isNotNull()
        return both.select(
            *[
                F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}")).alias(c)
                if c in keys
                else F.when(there, pick(F.col(c), matched, F.col(f"_new_{c}"))).otherwise(F.col(f"_new_{c}")).alias(c)
                for c in target.columns
            ]
        )
    # Sent to every executor, a small source leaves the target's rows where they are.
    side = F.broadcast if small else lambda df: df
    taken = [F.col(c) if c in keys else pick(F.col(c), matched, F.col(f"_new_{c}")).alias(c) for c in target.columns]
    kept = salted_join(target, side(incoming), keys, "left", hot)
    if small:
        known = salted_join(target.select(*keys), side(incoming.select(*keys)), keys, "left_semi", hot).distinct()
        kept = kept.select(*taken)
    else:
        # Hot and cold keys go through one pass over the target; its stored rows tell which keys were there.
        kept = materialize(kept.select(*taken, matched.alias("_matched")), "merged")
        known = kept.where("_matched").select(*keys).distinct()
        kept = kept.drop("_matched")
    added = source.where(all_present(keys)).join(known, list(keys), "left_anti")
    keyless = source.where(~all_present(keys))
    return kept.unionByName(added).unionByName(keyless)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], stored: bool = False) -> DataFrame:
    """Matched rows take all values of the source, other source rows are added.

    Extra source columns are ignored; several source rows with one key are an error.
    """
    return _combine(target, source, keys, stored, lambda old, matched, new: F.when(matched, new).otherwise(old))


def scd1(dimension: DataFrame, updates: DataFrame, keys: Sequence[str], stored: bool = False) -> DataFrame:
    """Overwrite attributes with the updates that have a value, add new keys, keep all others."""
    return _combine(dimension, updates, keys, stored, lambda old, matched, new: F.coalesce(new, old))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({c: F.when(true_only(condition), v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; unknown is not true."""
    return df.where(~true_only(condition))


def change_rows(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inserted, deleted and updated rows between two states of a table with unique keys; a repeated key fails the job.

    An update gives the row before and the row after it. Columns added later are null before. Values are
    compared null-safely, so a rewrite that changes nothing gives no rows. Rows with a missing key cannot be
    told to be the same row: they are compared as whole rows, by how often each occurs.
    """
    columns = list(dict.fromkeys([*after.columns, *before.columns]))

    def filled(df: DataFrame, other: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns]
        )

    before, after = filled(before, after), filled(after, before)
    keyed = all_present(keys)
    # Both states meet in one shuffle, which also tells whether a key is there twice.
    tagged = [
        df.where(keyed).select(*keys, F.struct(*columns).alias("_row"), F.lit(is_new).alias("_is_new"))
        for df, is_new in ((before, False), (after, True))
    ]
    sides = tagged[0].union(tagged[1]).groupBy(*keys).agg(
        F.first(F.when(~F.col("_is_new"), F.col("_row")), ignorenulls=True).alias("_old"),
        F.first(F.when(F.col("_is_new"), F.col("_row")), ignorenulls=True).alias("_new"),
        F.greatest(F.count_if("_is_new"), F.count_if(~F.col("_is_new"))).alias("_rows"),
    )
    repeated = F.raise_error(F.lit(f"several rows have the same key {list(keys)}")).cast("boolean")
    differs = ~F.col("_old").eqNullSafe(F.col("_new"))
    changed = sides.where(F.when(F.col("_rows") > 1, repeated).otherwise(differs))

    def row(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("row"))

    changes = (
        F.when(F.col("_old").isNull(), F.array(row("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(row("delete", "_old")))
        .otherwise(F.array(row("update_preimage", "_old"), row("update_postimage", "_new")))
    )
    with_key = changed.select(F.explode(changes).alias("change")).select("change.row.*", "change._change_type")
    lost, found = before.where(~keyed), after.where(~keyed)
    deleted = lost.exceptAll(found).withColumn("_change_type", F.lit("delete"))
    inserted = found.exceptAll(lost).withColumn("_change_type", F.lit("insert"))
    return with_key.unionByName(deleted).unionByName(inserted)


def scd2_start(dimension: DataFrame, effective: date) -> DataFrame:
    """Add the history columns to a dimension whose rows are all current."""
    return dimension.withColumns(
        {
            "effective_date": F.lit(effective),
            "end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def scd2_changes(dimension: DataFrame, updates: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Updates with a new key, or whose tracked values differ from the current row's.

    The updates are worked out once, and only the current rows that they ask for are joined.
    """
    updates = materialize(updates, "scd2-updates")
    require_unique(updates, keys)
    wanted = updates.where(all_present(keys)).select(*keys)
    current = lookup_join(dimension.where("is_current").select(*keys, *tracked), wanted, keys, "left_semi")
    old = current.select(*keys, F.struct(*tracked).alias("_old"), F.lit(True).alias("_known"))
    # Both sides have a key at most once; updates without a key match nothing and need no join.
    joined = old.join(updates.where(all_present(keys)), list(keys), "right")
    differs = F.col("_known").isNull() | ~F.col("_old").eqNullSafe(F.struct(*tracked))
    return joined.where(differs).select(*updates.columns).unionByName(updates.where(~all_present(keys)))


def scd2_apply(
    dimension: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: date | None = None,
) -> DataFrame:
    """End the current rows of changed keys the day before ``as_of`` and add their new versions.

    Older history and unchanged keys are carried through. ``as_of`` is today unless given.
    """
    today = F.lit(as_of) if as_of is not None else F.current_date()
    changes = materialize(scd2_changes(dimension, updates, keys, tracked), "scd2-changes")
    marked = lookup_join(dimension, changes.select(*keys, F.lit(True).alias("_changed")), keys, "left")
    expires = F.col("_changed").isNotNull() & F.col("is_current")
    history = marked.withColumns(
        {
            "end_date": F.when(expires, F.date_sub(today, 1)).otherwise(F.col("end_date")),
            "is_current": F.col("is_current") & ~expires,
        }
    ).drop("_changed")
    versions = changes.select(*keys, *tracked).withColumns(
        {"effective_date": today, "end_date": F.lit(None).cast("date"), "is_current": F.lit(True)}
    )
    return history.unionByName(versions)
