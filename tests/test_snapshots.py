from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lakeops.plans.audited_batch import AuditLog, audited_write, rollback_batch, rollback_if_needed
from lakeops.sources.snapshots import VersionedTable


@pytest.fixture
def data(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, v string")


@pytest.fixture
def versions(spark, tmp_path, data):
    versions = VersionedTable(spark, str(tmp_path / "t"))
    assert versions.current_version() is None
    assert versions.overwrite(data) == 0
    assert versions.append(spark.createDataFrame([(4, "d")], "id bigint, v string")) == 1
    assert versions.merge(spark.createDataFrame([(4, "D"), (5, "e")], "id bigint, v string"), ["id"]) == 2
    assert versions.delete(F.col("id") == 1) == 3
    return versions


def test_every_version_stays_readable(versions, rows):
    assert rows(versions.read(0)) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(versions.read(1)) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert rows(versions.read(2)) == [(1, "a"), (2, "b"), (3, "c"), (4, "D"), (5, "e")]
    assert rows(versions.read()) == [(2, "b"), (3, "c"), (4, "D"), (5, "e")]
    history = [tuple(r) for r in versions.history().select("version", "operation", "row_count").collect()]
    assert history == [(3, "DELETE", 4), (2, "MERGE", 5), (1, "APPEND", 4), (0, "WRITE", 3)]
    with pytest.raises(ValueError):
        versions.read(9)


def test_a_merge_writes_its_source_and_a_delete_only_numbers(versions):
    written = {r["version"]: (r["brought"], r["ended"]) for r in versions.history().collect()}
    assert written == {0: (3, 0), 1: (1, 0), 2: (2, 1), 3: (0, 1)}


def test_read_as_of_a_time(versions, rows):
    times = {r["version"]: r["commit_ts"] for r in versions.history().collect()}
    assert rows(versions.read(as_of=times[1])) == rows(versions.read(1))
    assert versions.version_at(datetime.now(timezone.utc) + timedelta(days=1)) == 3
    with pytest.raises(ValueError):
        versions.read(as_of=datetime(2000, 1, 1, tzinfo=timezone.utc))


def test_restore_brings_back_only_what_is_gone(versions, rows):
    assert versions.restore(1) == 4
    assert rows(versions.read()) == rows(versions.read(1))
    assert rows(versions.read(3)) == [(2, "b"), (3, "c"), (4, "D"), (5, "e")]
    newest = versions.history().first()
    assert (newest["brought"], newest["ended"], newest["row_count"]) == (2, 2, 4)
    assert rows(versions.change_feed(["id"], 4), "_change_type", "id", "v") == [
        ("delete", 5, "e"), ("insert", 1, "a"), ("update_postimage", 4, "d"), ("update_preimage", 4, "D"),
    ]


def test_restore_over_an_overwrite_and_over_other_partitions(spark, versions, data, rows):
    versions.overwrite(data.withColumn("v", F.upper("v")), partition_by=["v"])
    versions.append(spark.createDataFrame([(7, "G")], "id bigint, v string"))
    assert rows(versions.read()) == [(1, "A"), (2, "B"), (3, "C"), (7, "G")]
    versions.restore(2)
    assert rows(versions.read()) == rows(versions.read(2)) and versions.history().first()["row_count"] == 5
    versions.restore(5)
    assert rows(versions.read()) == [(1, "A"), (2, "B"), (3, "C"), (7, "G")]
    feed = rows(versions.change_feed(["id"], 4, 5), "_commit_version", "_change_type", "id", "v")
    assert feed[0] == (4, "delete", 4, "D") and feed[-1] == (5, "insert", 7, "G") and len(feed) == 8


def test_change_feed(versions, rows):
    feed = versions.change_feed(["id"], start=0)
    assert rows(feed, "_commit_version", "_change_type", "id", "v") == [
        (0, "insert", 1, "a"), (0, "insert", 2, "b"), (0, "insert", 3, "c"),
        (1, "insert", 4, "d"),
        (2, "insert", 5, "e"), (2, "update_postimage", 4, "D"), (2, "update_preimage", 4, "d"),
        (3, "delete", 1, "a"),
    ]
    versions.restore(3)
    assert versions.change_feed(["id"], start=4).count() == 0
    assert rows(versions.change_feed(["id"], 1, 1), "id") == [(4,)]
    for start, end in ((5, None), (2, 7), (3, 2)):
        with pytest.raises(ValueError):
            versions.change_feed(["id"], start, end)


def test_appended_columns_are_null_in_older_rows(spark, versions, rows):
    more = spark.createDataFrame([(9, 1.5)], "id bigint, score double")
    with pytest.raises(ValueError):
        versions.append(more)
    versions.append(more, merge_schema=True)
    assert rows(versions.read().where("id in (2, 9)")) == [(2, "b", None), (9, None, 1.5)]
    versions.drop_columns("v")
    assert versions.read().columns == ["id", "score"]
    assert versions.read(2).columns == ["id", "v"]
    with pytest.raises(ValueError):
        versions.append(spark.createDataFrame([(10, "again")], "id bigint, v string"), merge_schema=True)


def test_update_partitioned_clone_and_compact(spark, tmp_path, rows):
    orders = spark.range(100).select("id", (F.col("id") % 3).alias("kind"), F.lit("x").alias("note"))
    versions = VersionedTable(spark, str(tmp_path / "p"))
    versions.overwrite(orders.repartition(7), partition_by=["kind"])
    versions.append(orders.select(F.col("id") + 100, "kind", "note").toDF("id", "kind", "note"))
    versions.update(F.col("id") < 3, {"note": F.lit("y")})
    assert versions.read().columns == ["id", "kind", "note"]
    assert rows(versions.read().where("note = 'y'")) == [(0, 0, "y"), (1, 1, "y"), (2, 2, "y")]
    clone = versions.deep_clone(str(tmp_path / "clone"), version=0)
    assert rows(clone.read()) == rows(orders)
    before = rows(versions.read())
    versions.compact()
    assert rows(versions.read()) == before
    assert len(versions.read().inputFiles()) == 3
    plan = versions.read().where("kind = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
    versions.update(F.col("id") < 0, {"note": F.lit("z")})
    assert rows(versions.read()) == before


def test_a_write_that_died_blocks_nothing_and_is_never_read(spark, versions, rows):
    """Rows and ended numbers of a version without an audit row."""
    before, lost = rows(versions.read()), versions.current_version() + 1
    spark.createDataFrame([(99, "z", 0)], "id bigint, v string, _row bigint").write.parquet(f"{versions.root}/rows/_version={lost}")
    spark.createDataFrame([(0, 1)], "_version bigint, _row bigint").write.parquet(f"{versions.root}/ended/_by={lost}")
    assert rows(versions.read()) == before
    assert versions.delete(F.lit(False)) == lost and rows(versions.read()) == before
    assert versions.append(spark.createDataFrame([(6, "f")], "id bigint, v string")) == lost + 1
    assert rows(versions.read()) == [*before, (6, "f")]


def test_merge_where_one_key_column_is_hot_and_keys_are_missing(spark, tmp_path, rows):
    old = spark.range(900).select(F.when(F.col("id") % 3 > 0, 1).alias("k"), "id", F.lit("old").alias("v"))
    new = spark.range(0, 900, 9).select(F.when(F.col("id") % 2 == 0, 1).alias("k"), "id", F.lit("new").alias("v"))
    versions = VersionedTable(spark, str(tmp_path / "hot"))
    versions.overwrite(old)
    versions.merge(new, ["k", "id"])
    replaced = {i for i in range(0, 900, 9) if i % 2 == 0 and i % 3}
    want = [(1 if i % 3 else None, i, "old") for i in range(900) if i not in replaced]
    want += [(1 if i % 2 == 0 else None, i, "new") for i in range(0, 900, 9)]
    assert rows(versions.read()) == sorted(want, key=repr)


def test_failed_batches_are_recorded_and_rolled_back(spark, tmp_path, data, rows):
    table, audit = VersionedTable(spark, str(tmp_path / "t")), AuditLog(spark, str(tmp_path / "audit"))
    assert rollback_if_needed(table, audit) is None
    audited_write(lambda: data, table, audit, "in.json", 3, batch_id="b1")
    assert audit.latest("b1")["status"] == "SUCCESS"

    # A write that fails leaves no version, so there is nothing to roll back.
    audited_write(lambda: data, table, audit, "in.json", 3, partition_by=["ratings"], batch_id="b2")
    assert audit.latest("b2")["status"] == "FAILED"
    assert table.current_version() == 0

    # A batch that wrote before it failed does.
    table.overwrite(data.limit(1))
    audit.add("b3", "in.json", 1, table.current_version(), "FAILED")
    assert rollback_if_needed(table, audit) == 2
    assert rows(table.read()) == rows(data)
    last = audit.latest("b3")
    assert (last["status"], last["rollback_flag"], last["rollback_table_version"]) == ("SUCCESS", "Y", 0)
    assert rollback_if_needed(table, audit) is None

    assert rollback_batch(table, audit, "b1", 1) == 3
    assert table.read().count() == 1
    with pytest.raises(ValueError):
        audit.latest("nobody")
