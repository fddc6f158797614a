from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeops.operators import merge, skew

#: Lamps by number: what they are called and where they hang. One moves, one stays, one is new.
DIM = [(1, "arc", "hall"), (2, "beam", "attic"), (3, "coil", "yard")]
UPDATES = [(1, "arc", "porch"), (2, "beam", "attic"), (4, "disc", "cellar")]
SCHEMA = "lamp bigint, name string, place string"
KEYS, TRACKED = ["lamp"], ["name", "place"]


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(DIM, SCHEMA)


@pytest.fixture
def updates(spark):
    return spark.createDataFrame(UPDATES, SCHEMA)


@pytest.fixture(params=["broadcast", "shuffled"])
def any_join(request, monkeypatch):
    """Both ways a source can be joined."""
    if request.param == "shuffled":
        monkeypatch.setattr(merge, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)


def test_upsert_updates_and_inserts(dim, updates, rows, any_join):
    merged = merge.merge_upsert(dim, updates, KEYS)
    assert rows(merged) == [UPDATES[0], DIM[1], DIM[2], UPDATES[2]]
    # Merging again changes nothing.
    assert rows(merge.merge_upsert(merged, updates, KEYS)) == rows(merged)


def test_upsert_never_matches_missing_keys(spark, rows, any_join):
    target = spark.createDataFrame([(None, "a", "b"), (1, "c", "d")], SCHEMA)
    source = spark.createDataFrame([(None, "x", "y"), (None, "v", "w"), (1, None, "z")], SCHEMA)
    assert rows(merge.merge_upsert(target, source, KEYS)) == [
        (1, None, "z"), (None, "a", "b"), (None, "v", "w"), (None, "x", "y")]


def test_upsert_with_a_hot_target_key(spark, rows, any_join):
    target = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("lamp"),
        F.col("id").cast("string").alias("name"),
    )
    source = spark.createDataFrame([(7, "seven"), (101, "one"), (5000, "new")], "lamp bigint, name string")
    merged = merge.merge_upsert(target, source, KEYS)
    assert merged.count() == 901
    assert merged.where("lamp = 7 and name = 'seven'").count() == 300
    assert rows(merged.where("lamp in (101, 5000)")) == [(101, "one"), (5000, "new")]


def test_upsert_refuses_repeated_keys_and_missing_columns(dim, updates):
    with pytest.raises(ValueError, match="same key"):
        merge.merge_upsert(dim, updates.union(updates), KEYS)
    with pytest.raises(ValueError, match="lacks"):
        merge.merge_upsert(dim, updates.drop("name"), KEYS)


def test_scd1_keeps_rows_without_update(spark, dim, rows, any_join):
    updates = spark.createDataFrame([(1, None, "porch"), *UPDATES[1:]], SCHEMA)
    assert rows(merge.scd1(dim, updates, KEYS)) == [UPDATES[0], DIM[1], DIM[2], UPDATES[2]]


def test_scd2_history(spark, dim, updates, rows, any_join):
    start, today = date(2030, 3, 1), date(2031, 3, 1)
    history = merge.scd2_apply(merge.scd2_start(dim, start), updates, KEYS, TRACKED, today)
    assert rows(history) == sorted(
        [
            (*DIM[0], start, date(2031, 2, 28), False),
            (*UPDATES[0], today, None, True),
            (*DIM[1], start, None, True),
            (*DIM[2], start, None, True),
            (*UPDATES[2], today, None, True),
        ],
        key=repr,
    )
    # A second change ends only the current version; the first one stays as it was.
    again = spark.createDataFrame([(1, "arc", None)], SCHEMA)
    later = merge.scd2_apply(history, again, KEYS, TRACKED, date(2031, 4, 1))
    assert rows(later.where("lamp = 1"), "place", "end_date", "is_current") == sorted(
        [
            ("hall", date(2031, 2, 28), False),
            ("porch", date(2031, 3, 31), False),
            (None, None, True),
        ],
        key=repr,
    )
    # Nothing changed, nothing happens.
    assert rows(merge.scd2_apply(later, again, KEYS, TRACKED, date(2031, 5, 1))) == rows(later)


def test_scd2_changes(dim, updates, rows):
    changes = merge.scd2_changes(merge.scd2_start(dim, date(2030, 3, 1)), updates, KEYS, TRACKED)
    assert rows(changes) == [UPDATES[0], UPDATES[2]]


def test_update_and_delete_leave_unknown_alone(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, v string")
    assert rows(merge.delete_where(df, F.col("v") == "a")) == [(2, None), (3, "b")]
    assert rows(merge.update_where(df, F.col("v") == "a", {"id": F.col("id") + 10})) == [(11, "a"), (2, None), (3, "b")]


def apply_changes(before, changes, keys):
    gone = changes.where("_change_type in ('delete', 'update_preimage')")
    come = changes.where("_change_type in ('insert', 'update_postimage')").drop("_change_type")
    return before.join(gone, keys, "left_anti").unionByName(come)


def test_change_rows_lead_from_before_to_after(spark, rows):
    schema = "id int, v string, x double"
    before = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (5, None, 5.0)], schema)
    after = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0), (5, None, 5.0)], schema)
    changes = merge.change_rows(before, after, ["id"])
    assert rows(changes, "id", "_change_type") == [
        (2, "update_postimage"), (2, "update_preimage"), (3, "delete"), (4, "insert")]
    assert rows(apply_changes(before, changes, ["id"])) == rows(after)


def test_change_rows_with_an_added_column(spark, rows):
    before = spark.createDataFrame([(1, "a")], "id int, v string")
    after = spark.createDataFrame([(1, "a", None), (2, "b", 9)], "id int, v string, extra int")
    assert rows(merge.change_rows(before, after, ["id"])) == [(2, "b", 9, "insert")]


def test_change_rows_without_a_key_are_compared_whole(spark, rows):
    before = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), (1, "c")], "id int, v string")
    after = spark.createDataFrame([(None, "a"), (None, "d"), (1, "c")], "id int, v string")
    assert rows(merge.change_rows(before, after, ["id"])) == [
        (None, "a", "delete"), (None, "b", "delete"), (None, "d", "insert")]
