"""Upserts, dimensions, versions, change feeds and rollback."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lakeops.operators import merge
from lakeops.plans.audited_batch import AuditLog, audited_write, rollback_batch
from lakeops.queries.registry import query, table
from lakeops.session import work_dir
from lakeops.sources.snapshots import VersionedTable

# Updates derived from customers: those of one segment move (some lose their balance), those of another stay
# as they are, and each of a third brings a new customer.
UPDATES_SQL = """
    WITH updates AS (
      SELECT c_custkey, c_name || ' Ltd' AS c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal
      FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL
      SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY'
      UNION ALL
      SELECT c_custkey + 1000000000, 'New ' || c_name, c_acctbal FROM customer WHERE c_mktsegment = 'FURNITURE'
    )
"""
KEYS = ["c_custkey"]
TRACKED = ["c_name", "c_acctbal"]


def _customers(spark, sf):
    return table(spark, sf, "customer").select(*KEYS, *TRACKED)


def _updates(spark, sf):
    customers = table(spark, sf, "customer")
    moved = customers.where("c_mktsegment = 'BUILDING'").select(
        "c_custkey",
        F.concat("c_name", F.lit(" Ltd")).alias("c_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
    )
    same = customers.where("c_mktsegment = 'MACHINERY'").select(*KEYS, *TRACKED)
    new = customers.where("c_mktsegment = 'FURNITURE'").select(
        (F.col("c_custkey") + 1_000_000_000).alias("c_custkey"),
        F.concat(F.lit("New "), F.col("c_name")).alias("c_name"),
        "c_acctbal",
    )
    return moved.unionByName(same).unionByName(new)


MERGED_SQL = """
    SELECT c.c_custkey, CASE WHEN u.c_custkey IS NULL THEN c.c_name ELSE u.c_name END AS c_name,
           CASE WHEN u.c_custkey IS NULL THEN c.c_acctbal ELSE u.c_acctbal END AS c_acctbal
    FROM customer c LEFT JOIN updates u ON c.c_custkey = u.c_custkey
    UNION ALL
    SELECT c_custkey, c_name, c_acctbal FROM updates WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
"""


@query("merge_upsert", UPDATES_SQL + MERGED_SQL)
def merge_upsert(spark, sf):
    return merge.merge_upsert(_customers(spark, sf), _updates(spark, sf), KEYS)


@query(
    "merge_orders",
    """
    WITH late AS (
      SELECT l_orderkey AS o_orderkey, max(l_shipdate) AS shipped, round(sum(l_extendedprice), 2) AS price
      FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey
    )
    SELECT o_orderkey, coalesce(shipped, o_orderdate) AS o_orderdate, coalesce(price, o_totalprice) AS o_totalprice
    FROM orders LEFT JOIN late USING (o_orderkey)
    """,
)
def merge_orders(spark, sf):
    """Orders updated by their open lines; a source as large as the target."""
    late = (
        table(spark, sf, "lineitem")
        .where("l_linestatus = 'O'")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max("l_shipdate").alias("o_orderdate"), F.round(F.sum("l_extendedprice"), 2).alias("o_totalprice")
        )
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return merge.merge_upsert(orders, late, ["o_orderkey"])


@query(
    "update_delete",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_totalprice > 300000 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice, o_orderdate
    FROM orders WHERE NOT coalesce(o_orderpriority = '5-LOW', false)
    """,
)
def update_delete(spark, sf):
    orders = merge.delete_where(table(spark, sf, "orders"), F.col("o_orderpriority") == "5-LOW")
    updated = merge.update_where(
        orders,
        F.col("o_totalprice") > 300000,
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") - 1},
    )
    return updated.drop("o_orderpriority")


@query(
    "scd1",
    UPDATES_SQL
    + """
    SELECT c_custkey, coalesce(u.c_name, c.c_name) AS c_name, coalesce(u.c_acctbal, c.c_acctbal) AS c_acctbal
    FROM customer c FULL JOIN updates u USING (c_custkey)
    """,
)
def scd1(spark, sf):
    return merge.scd1(_customers(spark, sf), _updates(spark, sf), KEYS)


CHANGED_SQL = """
    , changed AS (
      SELECT u.* FROM updates u LEFT JOIN customer c ON u.c_custkey = c.c_custkey
      WHERE c.c_custkey IS NULL OR u.c_name IS DISTINCT FROM c.c_name OR u.c_acctbal IS DISTINCT FROM c.c_acctbal
    )
"""


@query("join_right_changes", UPDATES_SQL + CHANGED_SQL + "SELECT * FROM changed")
def join_right_changes(spark, sf):
    dimension = merge.scd2_start(_customers(spark, sf), date(2023, 1, 1))
    return merge.scd2_changes(dimension, _updates(spark, sf), KEYS, TRACKED)


@query(
    "scd2",
    UPDATES_SQL
    + CHANGED_SQL
    + """
    SELECT c_custkey, c_name, c_acctbal, DATE '2023-01-01' AS effective_date,
           CASE WHEN c_custkey IN (SELECT c_custkey FROM changed) THEN DATE '2024-05-31' END AS end_date,
           c_custkey NOT IN (SELECT c_custkey FROM changed) AS is_current
    FROM customer
    UNION ALL
    SELECT c_custkey, c_name, c_acctbal, DATE '2024-06-01', NULL, true FROM changed
    """,
)
def scd2(spark, sf):
    dimension = merge.scd2_start(_customers(spark, sf), date(2023, 1, 1))
    return merge.scd2_apply(dimension, _updates(spark, sf), KEYS, TRACKED, date(2024, 6, 1))


# Versions


def _versions(spark, sf) -> VersionedTable:
    """Customers in three versions: as they are, with the updates merged in, and without the debtors."""
    versions = VersionedTable(spark, work_dir(spark, "customers"))
    versions.overwrite(_customers(spark, sf))
    versions.merge(_updates(spark, sf), KEYS)
    versions.delete(F.col("c_acctbal") < 0)
    return versions


@query("version_as_of", UPDATES_SQL + MERGED_SQL)
def version_as_of(spark, sf):
    return _versions(spark, sf).read(version=1)


@query("timestamp_as_of", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def timestamp_as_of(spark, sf):
    versions = _versions(spark, sf)
    first = versions.history().where("version = 0").first()["commit_ts"]
    return versions.read(as_of=first)


@query("restore", UPDATES_SQL + MERGED_SQL)
def restore(spark, sf):
    versions = _versions(spark, sf)
    versions.restore(1)
    return versions.read()


@query(
    "history",
    UPDATES_SQL
    + ", merged AS ("
    + MERGED_SQL
    + """)
    SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, (SELECT count(*) FROM customer) AS row_count
    UNION ALL SELECT 1, 'MERGE', (SELECT count(*) FROM merged)
    UNION ALL SELECT 2, 'DELETE', (SELECT count(*) FROM merged WHERE coalesce(c_acctbal, 0) >= 0)
    UNION ALL SELECT 3, 'RESTORE', (SELECT count(*) FROM customer)
    """,
)
def history(spark, sf):
    versions = _versions(spark, sf)
    versions.restore(0)
    return versions.history().select("version", "operation", "row_count")


@query(
    "deep_clone",
    UPDATES_SQL + "SELECT * FROM (" + MERGED_SQL + ") WHERE coalesce(c_acctbal, 0) >= 0",
)
def deep_clone(spark, sf):
    return _versions(spark, sf).deep_clone(work_dir(spark, "clone")).read()


@query(
    "schema_evolve_append",
    """
    SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
    UNION ALL SELECT c_custkey + 1000000000, c_name, NULL, c_mktsegment FROM customer
    """,
)
def schema_evolve_append(spark, sf):
    versions = VersionedTable(spark, work_dir(spark, "evolving"))
    versions.append(_customers(spark, sf))
    more = table(spark, sf, "customer").select(
        (F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), "c_name", "c_mktsegment"
    )
    versions.append(more, merge_schema=True)
    return versions.read()


@query(
    "change_feed",
    UPDATES_SQL
    + ", merged AS ("
    + MERGED_SQL
    + """)
    SELECT *, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM merged
    WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL
    SELECT c.c_custkey, c.c_name, c.c_acctbal, 'update_preimage', 1 FROM customer c JOIN merged m USING (c_custkey)
    WHERE m.c_name IS DISTINCT FROM c.c_name OR m.c_acctbal IS DISTINCT FROM c.c_acctbal
    UNION ALL
    SELECT m.c_custkey, m.c_name, m.c_acctbal, 'update_postimage', 1 FROM customer c JOIN merged m USING (c_custkey)
    WHERE m.c_name IS DISTINCT FROM c.c_name OR m.c_acctbal IS DISTINCT FROM c.c_acctbal
    UNION ALL
    SELECT *, 'delete', 2 FROM merged WHERE c_acctbal < 0
    """,
)
def change_feed(spark, sf):
    return _versions(spark, sf).change_feed(KEYS, start=1).drop("_commit_timestamp")


@query(
    "rollback_batch",
    """
    SELECT 'good' AS batch_id, 'SUCCESS' AS status, 'N' AS rollback_flag, CAST(0 AS BIGINT) AS delta_table_version,
           CAST(NULL AS BIGINT) AS rollback_table_version, (SELECT count(*) FROM customer) AS rows_now
    UNION ALL SELECT 'wrong', 'SUCCESS', 'Y', 2, 0, (SELECT count(*) FROM customer)
    UNION ALL SELECT 'broken', 'FAILED', 'N', 2, NULL, (SELECT count(*) FROM customer)
    """,
)
def rollback(spark, sf):
    """Three batches: one good, one written and then rolled back, one whose write fails."""
    base = work_dir(spark, "batches")
    target, audit = VersionedTable(spark, f"{base}/target"), AuditLog(spark, f"{base}/audit")
    customers = table(spark, sf, "customer")
    source = f"{sf}/customer.parquet"
    audited_write(lambda: customers, target, audit, source, partition_by=["c_mktsegment"], batch_id="good")
    audited_write(lambda: customers.where("c_acctbal < 0"), target, audit, source, batch_id="wrong")
    rollback_batch(target, audit, "wrong", 0)
    audited_write(
        lambda: customers.drop("c_mktsegment"),
        target,
        audit,
        source,
        partition_by=["c_mktsegment"],
        batch_id="broken",
    )
    return audit.states().select(
        "batch_id",
        "status",
        "rollback_flag",
        "delta_table_version",
        "rollback_table_version",
        F.lit(target.read().count()).cast("bigint").alias("rows_now"),
    )


@query(
    "rollback_trigger",
    """
    SELECT 'good' AS batch_id, 'SUCCESS' AS status, 'N' AS rollback_flag, CAST(0 AS BIGINT) AS delta_table_version,
           CAST(NULL AS BIGINT) AS rollback_table_version, count(*) AS rows_now, CAST(sum(c_custkey) AS BIGINT) AS keys_now
    FROM customer
    UNION ALL SELECT 'half', 'SUCCESS', 'Y', 2, 0, count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
    """,
)
def rollback_trigger(spark, sf):
    """A batch that fails after it wrote half of its rows; its version is later than the good one, so it is undone."""
    base = work_dir(spark, "half-batch")
    target, audit = VersionedTable(spark, f"{base}/target"), AuditLog(spark, f"{base}/audit")
    customers, source = table(spark, sf, "customer").select("c_custkey", "c_acctbal"), f"{sf}/customer.parquet"

    def half():
        target.append(customers.where("c_acctbal < 0").withColumn("c_custkey", -F.col("c_custkey")))
        raise RuntimeError("the second half is missing")

    audited_write(lambda: customers, target, audit, source, batch_id="good")
    audited_write(half, target, audit, source, batch_id="half")
    left = target.read().agg(F.count(F.lit(1)).alias("rows_now"), F.sum("c_custkey").alias("keys_now")).first()
    return audit.states().select(
        "batch_id",
        "status",
        "rollback_flag",
        "delta_table_version",
        "rollback_table_version",
        F.lit(left["rows_now"]).cast("bigint").alias("rows_now"),
        F.lit(left["keys_now"]).cast("bigint").alias("keys_now"),
    )


@query(
    "drop_columns",
    """
    SELECT CAST(2 AS BIGINT) AS version, c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer
    UNION ALL SELECT 2, c_custkey + 1000000000, 'New ' || c_name, NULL FROM customer WHERE c_mktsegment = 'FURNITURE'
    UNION ALL SELECT 0, c_custkey, c_name, c_acctbal FROM customer
    """,
)
def drop_columns(spark, sf):
    """A column is dropped and rows without it come; the version from before still has it."""
    versions = VersionedTable(spark, work_dir(spark, "dropped"))
    versions.overwrite(_customers(spark, sf))
    versions.drop_columns("c_acctbal")
    versions.append(_updates(spark, sf).where("c_custkey >= 1000000000").drop("c_acctbal"))
    now, before = (
        versions.read(version).withColumn("version", F.lit(version).cast("bigint")) for version in (2, 0)
    )
    if "c_acctbal" in now.columns:
        raise AssertionError("the dropped column is still there")
    return now.unionByName(before, allowMissingColumns=True).select("version", *KEYS, *TRACKED)
