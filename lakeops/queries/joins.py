"""Joins, lookups, unions and balances."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import relational
from lakeops.operators.skew import grid_join, lookup_join, lookup_join_on, salted_join
from lakeops.queries.registry import query, table
from lakeops.session import materialize
from lakeops.sources.readers import query_table, read_path_sql


@query(
    "join_multi_key",
    """
    WITH totals AS (
      SELECT l_partkey, l_suppkey, count(*) AS lines, round(sum(l_quantity), 2) AS quantity
      FROM lineitem GROUP BY ALL
    )
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, lines, quantity
    FROM lineitem JOIN totals USING (l_partkey, l_suppkey)
    """,
)
def join_multi_key(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    totals = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )
    return salted_join(lines, totals, ["l_partkey", "l_suppkey"])


@query(
    "join_broadcast",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, s_suppkey, s_name, l_extendedprice
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def join_broadcast(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return lookup_join_on(lines, suppliers, {"l_suppkey": "s_suppkey"})


@query(
    "join_left_zero",
    """
    WITH net AS (
      SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END) AS net
      FROM orders GROUP BY o_custkey
    )
    SELECT c_custkey, c_acctbal, round(coalesce(net, 0), 2) AS net,
           round(c_acctbal + coalesce(net, 0), 2) AS final_balance
    FROM (
      SELECT c_custkey, c_acctbal FROM customer
      UNION ALL SELECT c_custkey + 1000000000, c_acctbal FROM customer WHERE c_custkey % 10 = 0
    ) LEFT JOIN net ON c_custkey = o_custkey
    """,
)
def join_left_zero(spark, sf):
    """Finished orders are credits, others debits; customers without orders keep their balance."""
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    without = customers.where("c_custkey % 10 = 0").withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000)
    balances = relational.final_balances(
        customers.union(without),
        "c_acctbal",
        orders.withColumnRenamed("o_custkey", "c_custkey"),
        "o_totalprice",
        F.col("o_orderstatus") == "F",
        "c_custkey",
    )
    return balances.withColumns({c: F.round(c, 2) for c in ("net", "final_balance")})


@query(
    "join_anti",
    """
    SELECT p_partkey, p_name FROM part
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)
    """,
)
def join_anti(spark, sf):
    """Parts never sold in a large line; sold parts are made distinct before they are shuffled."""
    large = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").select("p_partkey", "p_name").join(large.distinct(), "p_partkey", "left_anti")


@query(
    "join_three_way",
    """
    SELECT r_name, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name <> '' AND c_acctbal > 0
    GROUP BY r_name, c_mktsegment
    """,
)
def join_three_way(spark, sf):
    customers = table(spark, sf, "customer").where("c_acctbal > 0")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey").where("r_name <> ''")
    placed = lookup_join(customers, nations, ["c_nationkey"], "left")
    joined = lookup_join(placed, regions, ["n_regionkey"], "inner")
    return joined.groupBy("r_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query(
    "lookup_enrich",
    """
    SELECT s_suppkey, s_name, n_name, r_name FROM supplier
    LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def lookup_enrich(spark, sf):
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    enriched = relational.enrich(table(spark, sf, "supplier"), (nations, "s_nationkey"), (regions, "n_regionkey"))
    return enriched.select("s_suppkey", "s_name", "n_name", "r_name")


@query(
    "salted_join",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_returnflag = 'R' THEN 1 ELSE l_suppkey END AS s_suppkey,
           s_name
    FROM lineitem JOIN supplier ON s_suppkey = CASE WHEN l_returnflag = 'R' THEN 1 ELSE l_suppkey END
    """,
)
def join_salted(spark, sf):
    """Returned lines all go to one supplier, which so gets a third of the rows."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_returnflag") == "R", F.lit(1).cast("bigint")).otherwise(F.col("l_suppkey")).alias("s_suppkey"),
    )
    return salted_join(lines, table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"])


@query(
    "salted_left_join",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name
    FROM lineitem LEFT JOIN part
      ON p_partkey = CASE WHEN l_linestatus = 'F' THEN NULL WHEN l_partkey % 7 = 0 THEN -l_partkey ELSE l_partkey END
    """,
)
def join_salted_left(spark, sf):
    """Lines of closed orders have no key at all; as a hot group they are spread too, and all kept."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_linestatus") == "F", F.lit(None))
        .when(F.col("l_partkey") % 7 == 0, -F.col("l_partkey"))
        .otherwise(F.col("l_partkey"))
        .alias("p_partkey"),
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return salted_join(lines, parts, ["p_partkey"], "left").drop("p_partkey")


_BOTH_HOT = """
    WITH a AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 WHEN o_orderkey % 3 = 1 THEN o_custkey % 700 END AS site
      FROM orders
    ),
    b AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey END AS site, s_suppkey, s_nationkey FROM supplier)
"""


def _both_hot(spark, sf):
    """A third of the orders and a third of the suppliers are at one site; another third of the orders has none."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0).cast("bigint"))
        .when(F.col("o_orderkey") % 3 == 1, F.col("o_custkey") % 700)
        .cast("bigint")
        .alias("site"),
    )
    site = F.when(F.col("s_suppkey") % 3 == 0, F.lit(0)).otherwise(F.col("s_suppkey")).cast("bigint").alias("site")
    return orders, table(spark, sf, "supplier").select(site, "s_suppkey", "s_nationkey")


@query(
    "grid_join",
    _BOTH_HOT
    + """
    SELECT site, s_nationkey, count(*) AS pairs, CAST(sum(o_orderkey % 100) AS BIGINT) AS marks
    FROM a JOIN b USING (site) GROUP BY site, s_nationkey
    """,
)
def join_grid(spark, sf):
    """Every pair is counted, but orders of one site and mark, and suppliers of one site and nation, are joined once."""
    orders, suppliers = _both_hot(spark, sf)
    marked = orders.select("site", (F.col("o_orderkey") % 100).alias("mark"))
    joined = grid_join(marked, suppliers.select("site", "s_nationkey"), ["site"], pairs="n")
    return joined.groupBy("site", "s_nationkey").agg(
        F.sum("n").alias("pairs"), F.sum(F.col("mark") * F.col("n")).alias("marks")
    )


@query(
    "grid_left_join",
    _BOTH_HOT
    + """
    SELECT o_orderkey, any_value(a.site) AS site, count(s_suppkey) AS suppliers, min(s_suppkey) AS first_supplier
    FROM a LEFT JOIN b ON a.site = b.site GROUP BY o_orderkey
    """,
)
def join_grid_left(spark, sf):
    """A site's suppliers are counted once, not once per order; every order is then joined with its site."""
    orders, suppliers = _both_hot(spark, sf)
    at_site = suppliers.groupBy("site").agg(F.count("s_suppkey").alias("n"), F.min("s_suppkey").alias("first"))
    joined = grid_join(orders, materialize(at_site, "sites"), ["site"], "left")
    return joined.groupBy("o_orderkey").agg(
        F.any_value("site").alias("site"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("suppliers"),
        F.min("first").alias("first_supplier"),
    )


@query(
    "union_by_name",
    """
    SELECT * FROM (
      SELECT c_name AS name, c_nationkey AS nation, 'customer' AS kind FROM customer
      UNION ALL SELECT s_name, s_nationkey, 'supplier' FROM supplier
    ) ORDER BY nation, name
    """,
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers).orderBy("nation", "name")


@query(
    "available_columns",
    "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_clerk, o_totalprice, CAST(NULL AS VARCHAR) AS o_comment FROM orders",
)
def available_columns(spark, sf):
    """The wanted columns in the wanted order; those the table lacks are null."""
    wanted = ["o_orderkey", "o_clerk", "o_totalprice", "o_comment"]
    return relational.present_columns(table(spark, sf, "orders"), wanted, add_missing=True)


@query(
    "param_query",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def param_query(spark, sf):
    """Table and value are parameters of the SQL text, not parts of it."""
    table(spark, sf, "customer").createOrReplaceTempView("param_query_customer")
    rows = query_table(spark, "param_query_customer", "c_mktsegment", "BUILDING")
    return rows.select("c_custkey", "c_name", "c_mktsegment")


@query("sql_on_path", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def sql_on_path(spark, sf):
    rows = read_path_sql(spark, f"{sf.rstrip('/')}/orders.parquet", "o_orderpriority = '1-URGENT'")
    return rows.select("o_orderkey", "o_custkey")
