"""Ranks, windows, gaps and streaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.change import as_percent_text
from lakeops.operators import dedup, ranking, relational, sequences, windows
from lakeops.operators.skew import lookup_join
from lakeops.queries.registry import query, table


@query(
    "nth_highest",
    """
    SELECT c_nationkey, c_name, c_acctbal FROM (
      SELECT *, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS r FROM customer
    ) WHERE r = 2
    """,
)
def nth_highest(spark, sf):
    rows = ranking.nth_highest(table(spark, sf, "customer"), ["c_nationkey"], "c_acctbal", 2)
    return rows.select("c_nationkey", "c_name", "c_acctbal")


@query(
    "group_stats",
    """
    SELECT s_nationkey, round(avg(s_acctbal), 4) AS avg_value, max(s_acctbal) AS max_value,
           min(s_acctbal) AS min_value
    FROM supplier GROUP BY s_nationkey
    """,
)
def group_stats(spark, sf):
    stats = ranking.group_stats(table(spark, sf, "supplier"), ["s_nationkey"], "s_acctbal")
    return stats.withColumn("avg_value", F.round("avg_value", 4))


@query("bonus", "SELECT s_suppkey, s_acctbal, round(s_acctbal * 0.1, 4) AS bonus FROM supplier")
def bonus(spark, sf):
    rows = ranking.with_bonus(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal")
    return rows.withColumn("bonus", F.round("bonus", 4))


@query(
    "rank_two_keys",
    """
    SELECT o_orderkey, o_orderpriority, o_custkey, o_totalprice,
           CAST(rank() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_totalprice DESC) AS BIGINT)
             AS price_rank
    FROM orders
    """,
)
def rank_two_keys(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey", "o_totalprice")
    return ranking.rank_within(orders, ["o_orderpriority", "o_custkey"], "o_totalprice", "price_rank")


@query(
    "rank_hot_groups",
    """
    SELECT l_orderkey, l_linenumber, l_linestatus, l_returnflag, l_quantity,
           CAST(rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity DESC) AS BIGINT)
             AS quantity_rank
    FROM lineitem
    """,
)
def rank_hot_groups(spark, sf):
    """Every group holds a large part of the rows, and every value many ties."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity"
    )
    return ranking.rank_within(lines, ["l_returnflag", "l_linestatus"], "l_quantity", "quantity_rank")


@query(
    "latest_per_key",
    """
    SELECT event_id, user_id, event_type, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
      FROM events
    ) WHERE r = 1
    """,
)
def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return ranking.latest_per_key(events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])


@query(
    "lag_lead_gap",
    """
    WITH monthly AS (
      SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             round(sum(o_totalprice), 2) AS revenue
      FROM orders GROUP BY ALL
    )
    SELECT o_orderpriority, month, revenue, previous, following,
           round((revenue - previous) / revenue * 100, 4) AS gap_pct
    FROM (
      SELECT *, lag(revenue) OVER w AS previous, lead(revenue) OVER w AS following
      FROM monthly WINDOW w AS (PARTITION BY o_orderpriority ORDER BY month)
    )
    """,
)
def lag_lead_gap(spark, sf):
    monthly = (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    )
    gaps = windows.period_gap(monthly, "month", "revenue", ["o_orderpriority"], bounded=True)
    return gaps.withColumn("gap_pct", F.round("gap_pct", 4))


@query(
    "gap_text",
    """
    WITH yearly AS (
      SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS order_year, round(sum(o_totalprice), 2) AS revenue
      FROM orders GROUP BY ALL
    )
    SELECT o_orderstatus, order_year,
           CAST(round((revenue - lag(revenue) OVER w) / revenue * 100, 2) AS VARCHAR) || '%' AS revenue_gap
    FROM yearly WINDOW w AS (PARTITION BY o_orderstatus ORDER BY order_year)
    """,
)
def gap_text(spark, sf):
    """The change from the year before as text; none in the first year."""
    yearly = (
        table(spark, sf, "orders")
        .groupBy("o_orderstatus", F.year("o_orderdate").alias("order_year"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    )
    gaps = windows.period_gap(yearly, "order_year", "revenue", ["o_orderstatus"], bounded=True)
    return gaps.select("o_orderstatus", "order_year", as_percent_text(F.col("gap_pct"), 2).alias("revenue_gap"))


@query(
    "lag_lead_rows",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           lag(o_totalprice) OVER w AS previous, lead(o_totalprice) OVER w AS following
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey)
    """,
)
def lag_lead_rows(spark, sf):
    """Single orders in three groups, so that each group is cut into chunks."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return windows.lag_lead(orders, "o_orderkey", "o_totalprice", ["o_orderstatus"])


@query(
    "yoy_change",
    """
    WITH yearly AS (
      SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, round(sum(o_totalprice), 2) AS total
      FROM orders GROUP BY ALL
    )
    SELECT order_year, total, previous_total,
           round((total - previous_total) / previous_total * 100, 2) AS change_pct
    FROM (SELECT *, lag(total) OVER (ORDER BY order_year) AS previous_total FROM yearly)
    """,
)
def yoy_change(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("order_year"), "o_orderkey", "o_totalprice"
    )
    changes = windows.year_over_year(orders, "order_year", F.col("o_totalprice"))
    return changes.withColumns(
        {"total": F.round("total", 2), "previous_total": F.round("previous_total", 2)}
    )


@query(
    "yoy_equal_rows",
    """
    WITH yearly AS (
      SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total
      FROM lineitem GROUP BY ALL
    )
    SELECT ship_year, total, lag(total) OVER (ORDER BY ship_year) AS previous_total FROM yearly
    """,
)
def yoy_equal_rows(spark, sf):
    """Many lines of a year have the same quantity, and each of them counts."""
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return windows.year_over_year(lines, "ship_year", F.col("quantity")).drop("change_pct")


@query(
    "pair_dedup_missing_ends",
    """
    WITH pairs AS (
      SELECT nullif(o_custkey % 7, 3) AS source, nullif(o_orderkey % 5, 2) AS destination FROM orders
    )
    SELECT source, destination FROM (
      SELECT source, destination, row_number() OVER (
        PARTITION BY least(coalesce(source, -1), coalesce(destination, -1)),
                     greatest(coalesce(source, -1), coalesce(destination, -1))
        ORDER BY coalesce(source, -1)) AS place
      FROM pairs
    ) WHERE place = 1
    """,
)
def pair_dedup_missing_ends(spark, sf):
    """Pairs of which either end, or both, may be missing."""
    pairs = table(spark, sf, "orders").select(
        F.nullif(F.col("o_custkey") % 7, F.lit(3)).alias("source"),
        F.nullif(F.col("o_orderkey") % 5, F.lit(2)).alias("destination"),
    )
    return dedup.undirected_pairs(pairs, "source", "destination")


@query(
    "moving_avg",
    """
    WITH daily AS (
      SELECT CAST(ts AS DATE) AS day, round(sum(value), 2) AS total FROM events GROUP BY ALL
    )
    SELECT day, total, round(avg(total) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4)
      AS moving_avg
    FROM daily
    """,
)
def moving_avg(spark, sf):
    daily = (
        table(spark, sf, "events")
        .groupBy(F.col("ts").cast("date").alias("day"))
        .agg(F.round(F.sum("value"), 2).alias("total"))
    )
    return windows.moving_average(daily, "day", "total", bounded=True).withColumn(
        "moving_avg", F.round("moving_avg", 4)
    )


@query(
    "moving_avg_rows",
    """
    SELECT o_orderkey, o_totalprice,
           round(avg(o_totalprice) OVER (ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4)
             AS moving_avg
    FROM orders
    """,
)
def moving_avg_rows(spark, sf):
    """All orders form one sequence, cut into chunks that carry two rows over."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return windows.moving_average(orders, "o_orderkey", "o_totalprice").withColumn(
        "moving_avg", F.round("moving_avg", 4)
    )


@query(
    "moving_avg_per_type",
    """
    SELECT event_id, event_type, ts, round(avg(value) OVER w, 4) AS moving_avg
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
    """,
)
def moving_avg_per_type(spark, sf):
    """Five latest events of the same type, in the order of their time."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    averages = windows.moving_average(events, ["ts", "event_id"], "value", ["event_type"], rows=5)
    return averages.select("event_id", "event_type", "ts", F.round("moving_avg", 4).alias("moving_avg"))


@query(
    "moving_avg_ties",
    """
    SELECT l_orderkey, l_linenumber, round(avg(l_quantity) OVER w, 4) AS moving_avg
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag
                               ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
                               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    """,
)
def moving_avg_ties(spark, sf):
    """Many lines ship on one day, and order and line number repeat; the quantity itself tells the last of them apart."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    lines = table(spark, sf, "lineitem").select("l_returnflag", *order)
    averages = windows.moving_average(lines, order, "l_quantity", ["l_returnflag"], rows=7)
    return averages.select("l_orderkey", "l_linenumber", F.round("moving_avg", 4).alias("moving_avg"))


@query(
    "moving_avg_hot_order",
    """
    SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           round(avg(l_quantity) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 4) AS moving_avg
    FROM lineitem WINDOW w AS (ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)
    """,
)
def moving_avg_hot_order(spark, sf):
    """One sequence whose first order value is the same for a large part of the rows, so cuts lie inside that value."""
    order = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    lines = table(spark, sf, "lineitem").select(*order)
    averages = windows.moving_average(lines, order, "l_quantity", rows=5)
    return averages.withColumn("moving_avg", F.round("moving_avg", 4))


@query(
    "lag_lead_even_rows",
    """
    SELECT o_orderstatus, o_orderpriority, lag(o_orderpriority) OVER w AS previous, lead(o_orderpriority) OVER w AS following
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderpriority)
    """,
)
def lag_lead_even_rows(spark, sf):
    """Thousands of orders of a status are alike in all that is asked for; any of them may come first."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    return windows.lag_lead(orders, "o_orderpriority", "o_orderpriority", ["o_orderstatus"])


@query(
    "date_gaps",
    """
    WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    pairs AS (SELECT *, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous_day FROM days)
    SELECT user_id, previous_day, day, previous_day + 1 AS missing_from, day - 1 AS missing_to
    FROM pairs WHERE date_diff('day', previous_day, day) > 1
    """,
)
def date_gaps(spark, sf):
    days = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"))
    return sequences.date_gaps(days, ["user_id"], "day")


@query(
    "missing_dates",
    """
    WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    spans AS (SELECT user_id, min(day) AS a, max(day) AS b FROM days GROUP BY user_id),
    calendar AS (
      SELECT user_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
        AS day FROM spans
    )
    SELECT user_id, day FROM calendar ANTI JOIN days USING (user_id, day)
    """,
)
def missing_dates(spark, sf):
    days = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"))
    return sequences.missing_dates(days, ["user_id"], "day")


@query(
    "missing_ints",
    """
    WITH r AS (SELECT min(l_orderkey) AS a, max(l_orderkey) AS b FROM lineitem)
    SELECT n AS l_orderkey FROM (SELECT unnest(generate_series(a, b)) AS n FROM r)
    WHERE n NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def missing_ints(spark, sf):
    return sequences.missing_integers(table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "login_streaks",
    """
    WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    runs AS (
      SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM days
    )
    SELECT user_id, min(day) AS start_date, max(day) AS end_date, count(*) AS consecutive_days
    FROM runs GROUP BY user_id, run HAVING count(*) >= 5
    """,
)
def login_streaks(spark, sf):
    days = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"))
    return sequences.streaks(days, ["user_id"], "day", 5)


@query(
    "pair_dedup",
    """
    WITH trades AS (
      SELECT c_nationkey AS source, s_nationkey AS destination
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    )
    SELECT min(source) AS source,
           CASE WHEN min(source) = least(source, destination) THEN greatest(source, destination)
                ELSE least(source, destination) END AS destination
    FROM trades GROUP BY least(source, destination), greatest(source, destination)
    """,
)
def pair_dedup(spark, sf):
    """Trading nations: who buys from whom, either way round."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    buyers = lookup_join(orders, customers, ["o_custkey"], "inner").select(
        "l_orderkey", F.col("c_nationkey").alias("source")
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    sold = lookup_join(lines, suppliers, ["l_suppkey"], "inner")
    # Both sides are scans with lookups, which adaptive execution can split where an order is hot.
    trades = sold.join(buyers, "l_orderkey")
    pairs = trades.select("source", F.col("s_nationkey").alias("destination"))
    return dedup.undirected_pairs(pairs, "source", "destination")


@query(
    "repeat_keys",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN (
      SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    )
    """,
)
def repeat_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return dedup.rows_with_repeated_key(lines, ["l_orderkey", "l_linenumber"])


@query(
    "mean_fill",
    """
    WITH readings AS (
      SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events
    )
    SELECT event_id, CAST(user_id AS DOUBLE) AS user_id,
           round(coalesce(value, (SELECT avg(value) FROM readings)), 4) AS value
    FROM readings
    """,
)
def mean_fill(spark, sf):
    """Events of type error have no reading."""
    readings = table(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    filled = relational.mean_fill(readings, ["user_id", "value"])
    return filled.withColumn("value", F.round("value", 4))
