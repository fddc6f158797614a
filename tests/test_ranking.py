import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import ranking

#: Apples by orchard: two of a weight, one without a weight.
APPLES = [("a1", "hill", 142), ("a2", "hill", 97), ("a3", "lake", 180), ("a4", "lake", 180), ("a5", "lake", 66),
          ("a6", "road", None)]


@pytest.fixture(scope="module")
def apples(spark):
    return spark.createDataFrame(APPLES, "tag string, orchard string, grams int")


def test_second_highest_counts_distinct_values(apples, rows):
    got = ranking.nth_highest(apples, ["orchard"], "grams", 2)
    assert rows(got, "orchard", "tag", "grams") == [("hill", "a2", 97), ("lake", "a5", 66)]
    assert rows(ranking.nth_highest(apples, ["orchard"], "grams", 1), "orchard", "grams")[-1] == ("road", None)


def test_nth_highest_keeps_all_ties(spark, rows):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 2 == 0, 99).otherwise(F.col("id") % 10).alias("v"),
        "id",
    )
    window = Window.partitionBy("k").orderBy(F.col("v").desc())
    for n in (1, 2, 4):
        plain = many.withColumn("r", F.dense_rank().over(window)).where(F.col("r") == n).drop("r")
        assert rows(ranking.nth_highest(many, ["k"], "v", n)) == rows(plain)


def test_rank_within_two_keys(spark, rows):
    jumps = spark.createDataFrame(
        [("may", "high", 171), ("may", "high", 168), ("may", "high", 171), ("may", "long", 540), ("june", "high", 175),
         ("june", "long", 512), ("june", "long", 533)],
        "month string, kind string, cm int",
    )
    got = ranking.rank_within(jumps, ["month", "kind"], "cm", "place", hot={})
    assert dict(got.dtypes)["place"] == "bigint"
    assert rows(got) == [("june", "high", 175, 1), ("june", "long", 512, 2), ("june", "long", 533, 1),
                         ("may", "high", 168, 3), ("may", "high", 171, 1), ("may", "high", 171, 1), ("may", "long", 540, 1)]


def test_rank_of_a_hot_group_equals_the_plain_rank(spark, rows):
    data = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 40))
        .alias("k"),
        F.when(F.col("id") % 11 != 0, F.col("id") * 37 % 400).alias("v"),
        "id",
    )
    plain = data.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc())))
    got = ranking.rank_within(data, ["k"], "v", "r")
    assert rows(got, "id", "r") == rows(plain, "id", "r")


def test_latest_per_key_breaks_ties(spark, rows):
    events = spark.createDataFrame(
        [(1, 1, 5, "a"), (1, 1, 5, "b"), (1, 2, 3, "c"), (2, 1, 9, "d"), (2, 1, 4, "e")],
        "user_id int, product_id int, at int, note string",
    )
    got = ranking.latest_per_key(events, ["user_id", "product_id"], [F.col("at").desc(), F.col("note").desc()])
    assert rows(got) == [(1, 1, 5, "b"), (1, 2, 3, "c"), (2, 1, 9, "d")]


def test_latest_per_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = ranking.latest_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_group_stats_and_bonus(apples, rows):
    assert rows(ranking.group_stats(apples, ["orchard"], "grams")) == [
        ("hill", 119.5, 142, 97), ("lake", 142.0, 180, 66), ("road", None, None, None)]
    assert [r[0] for r in rows(ranking.with_bonus(apples.where("tag = 'a3'"), "grams"), "bonus")] == [18.0]


def test_top_by_count_orders_ties_by_value(spark):
    words = spark.createDataFrame([(w,) for w in "b b a a c d".split()], "word string")
    assert [tuple(r) for r in ranking.top_by_count(words, "word", 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_rank_where_many_rows_share_a_value(spark, rows):
    """A value that is cut into several chunks, at the top, in the middle and at the bottom of its group."""
    for share in (100, 50, 0, None):
        data = spark.range(6000).select(
            F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 2 == 1, None).alias("k"),
            F.when(F.col("id") % 5 < 3, F.lit(share)).otherwise(F.col("id") % 101).alias("v"),
        )
        plain = data.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc())))
        got = ranking.rank_within(data, ["k"], "v", "r")
        assert rows(got) == rows(plain)


def test_rank_of_numbers_that_are_none(spark, rows):
    data = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, float("nan")).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 9 * -0.0).alias("v"),
        F.lit(1).alias("k"),
    )
    plain = data.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc())))
    assert rows(ranking.rank_within(data, ["k"], "v", "r"), "r") == rows(plain, "r")
