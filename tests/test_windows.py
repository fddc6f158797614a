import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.functions.change import as_percent_text, number_from_text, percent_change
from lakeops.operators import windows
from lakeops.operators.skew import hot_groups

#: Hours of sun by town and season.
SUN = [
    ("cove", 1, 64),
    ("cove", 2, 80),
    ("cove", 3, 50),
    ("dell", 1, 30),
    ("dell", 2, 30),
    ("fell", 2, 12),
]


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with a third of the rows, one with nulls for a key, and many small ones; odd gaps in the order."""
    return (
        spark.range(6000)
        .select(
            F.when(F.col("id") % 3 == 0, "hot")
            .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500))
            .alias("key"),
            (F.col("id") * 7 % 6000 * 3).alias("place"),
            (F.col("id") * 31 % 97).cast("double").alias("value"),
        )
        .repartition(6)
        .dropDuplicates(["place"])
        .persist()
    )


def test_gap_text_divides_by_the_current_value(spark, rows):
    sun = spark.createDataFrame(SUN, "town string, season int, hours bigint")
    gaps = windows.period_gap(sun, "season", "hours", ["town"], bounded=True)
    shown = gaps.withColumn("text", as_percent_text(F.col("gap_pct"), 2))
    assert rows(shown, "town", "season", "previous", "following", "text") == [
        ("cove", 1, None, 80, None),
        ("cove", 2, 64, 50, "20.0%"),
        ("cove", 3, 80, None, "-60.0%"),
        ("dell", 1, None, 30, None),
        ("dell", 2, 30, None, "0.0%"),
        ("fell", 2, None, None, None),
    ]


def test_percent_change_base_and_zero(spark):
    df = spark.createDataFrame([(50.0, 40.0), (0.0, 40.0), (5.0, 0.0)], "a double, b double")
    got = df.select(
        percent_change(F.col("a"), F.col("b")).alias("c"), percent_change(F.col("a"), F.col("b"), "previous").alias("p")
    ).collect()
    assert [tuple(r) for r in got] == [(20.0, 25.0), (None, -100.0), (100.0, None)]
    with pytest.raises(ValueError):
        percent_change(F.col("a"), F.col("b"), "next")


def test_year_over_year_counts_equal_rows_each(spark, rows):
    harvest = spark.createDataFrame(
        [("2031", "2,400"), ("2032", "900"), ("2032", "900"), ("2034", "2,700")], "year string, crates string"
    )
    got = windows.year_over_year(harvest, "year", number_from_text(F.col("crates")))
    assert rows(got, "year", "total", "previous_total", "change_pct") == [
        ("2031", 2400.0, None, None),
        ("2032", 1800.0, 2400.0, -25.0),
        ("2034", 2700.0, 1800.0, 50.0),
    ]


@pytest.mark.parametrize("bounded", [True, False])
def test_moving_average_of_three_rows(spark, rows, bounded):
    sales = spark.createDataFrame([(d, s) for d, s in enumerate((9, 3, 6, 30, 0, 3))], "day int, sales int")
    got = windows.moving_average(sales, "day", "sales", bounded=bounded)
    assert [r[2] for r in rows(got)] == [9.0, 6.0, 6.0, 13.0, 12.0, 11.0]


def test_hot_groups_are_found_with_their_share(spark, skewed):
    hot = hot_groups(skewed, ["key"])
    shares = sorted(hot.values())
    # The hot key and the missing one, a third each.
    assert len(hot) == 2 and all(0.3 < share < 0.37 for share in shares)
    assert hot_groups(skewed.limit(0), ["key"]) == {}


def test_chunks_rise_with_the_order(spark, skewed):
    chunked = windows.order_chunks(skewed, "place", ["key"])
    per_chunk = chunked.where("key = 'hot'").groupBy("_chunk").agg(F.min("place"), F.max("place"), F.count("*"))
    chunks = [tuple(row) for row in per_chunk.orderBy("_chunk").collect()]
    assert len(chunks) >= 2
    assert all(a[2] < b[1] for a, b in zip(chunks, chunks[1:]))
    assert max(c[3] for c in chunks) < 0.7 * sum(c[3] for c in chunks)
    assert chunked.where("key like 'k%' and _chunk <> -1").count() == 0


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("length", [2, 3, 7])
def test_cut_windows_equal_whole_windows(spark, rows, skewed, keys, length):
    window = Window.partitionBy(*keys).orderBy("place")
    whole = skewed.withColumn("m", F.avg("value").over(window.rowsBetween(1 - length, 0)))
    cut = windows.moving_average(skewed, "place", "value", keys, length, "m")
    assert rows(cut, "place", F.round("m", 9)) == rows(whole, "place", F.round("m", 9))


@pytest.mark.parametrize("keys", [["key"], []])
def test_cut_lag_and_lead_equal_whole(spark, rows, skewed, keys):
    window = Window.partitionBy(*keys).orderBy("place")
    whole = skewed.withColumns({"p": F.lag("value").over(window), "f": F.lead("value").over(window)})
    cut = windows.lag_lead(skewed, "place", "value", keys, "p", "f")
    assert cut.columns == ["key", "place", "value", "p", "f"]
    assert rows(cut) == rows(whole)


def test_texts_can_be_the_order(spark, rows, skewed):
    data = skewed.withColumn("month", F.format_string("m%05d", "place"))
    window = Window.partitionBy("key").orderBy("month")
    whole = data.withColumns({"previous": F.lag("value").over(window), "following": F.lead("value").over(window)})
    chunked = windows.order_chunks(data, "month", ["key"])
    assert chunked.where("key = 'hot'").select("_chunk").distinct().count() >= 2
    assert rows(windows.lag_lead(data, "month", "value", ["key"])) == rows(whole)


def test_not_a_number_orders_last(spark, rows):
    data = spark.range(500).select(
        F.when(F.col("id") == 250, float("nan")).otherwise(F.col("id").cast("double")).alias("place"),
        F.col("id").alias("value"),
    )
    window = Window.orderBy("place")
    got = windows.lag_lead(data, "place", "value").select("value", "previous", "following")
    whole = data.select("value", F.lag("value").over(window), F.lead("value").over(window))
    assert rows(got) == rows(whole)


def test_rows_are_carried_over_chunks_shorter_than_the_frame(spark, rows):
    few = spark.range(5).select(F.col("id").alias("place"), F.col("id").cast("double").alias("value"))
    window = Window.orderBy("place").rowsBetween(-3, 0)
    whole = few.withColumn("m", F.avg("value").over(window))
    assert rows(windows.moving_average(few, "place", "value", rows=4, name="m")) == rows(whole)


def test_missing_order_values_come_first(spark, rows):
    data = spark.range(100).select(F.when(F.col("id") > 0, F.col("id")).alias("place"), F.col("id").alias("value"))
    window = Window.orderBy("place")
    assert rows(windows.lag_lead(data, "place", "value")) == rows(
        data.withColumns({"previous": F.lag("value").over(window), "following": F.lead("value").over(window)})
    )


@pytest.fixture(scope="module")
def one_value(spark):
    """Half of the rows have the same first order value, and an eighth are all alike."""
    day = F.when(F.col("id") % 2 == 0, 50).otherwise(F.col("id") % 100)
    number = F.when(F.col("id") % 8 == 0, 0).otherwise(F.col("id"))
    return spark.range(8000).select(day.alias("day"), number.alias("number"), (number % 7).cast("double").alias("value"))


def test_a_hot_order_value_is_cut_inside(spark, one_value):
    stored = windows.with_places(one_value)
    chunks = windows.order_chunks(stored, ["day", "number", "_tie", "_place"]).groupBy("_chunk")
    sizes = [r["count"] for r in chunks.count().collect()]
    # Eight tasks, so sixteen chunks; each holds about a sixteenth, also of the rows that are alike.
    assert len(sizes) > 8 and max(sizes) < 8000 / 8
    ranges = chunks.agg(F.min(F.struct("day", "number")).alias("a"), F.max(F.struct("day", "number")).alias("b"))
    ends = [(tuple(r["a"]), tuple(r["b"])) for r in ranges.orderBy("_chunk").collect()]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_windows_over_a_hot_order_value_equal_plain_ones(spark, one_value, rows):
    window = Window.orderBy("day", "number")
    columns = {"p": F.lag("number").over(window), "m": F.avg("value").over(window.rowsBetween(-4, 0))}
    plain = one_value.withColumns(columns)
    order = ["day", "number"]
    got = windows.over_rows(
        one_value,
        order,
        {"p": lambda w: F.lag("number").over(w), "m": lambda w: F.avg("value").over(w.rowsBetween(-4, 0))},
        back=4,
    )
    assert rows(got) == rows(plain)


def test_equal_order_values_follow_the_row_in_any_partitioning(spark, rows):
    data = spark.range(600).select((F.col("id") % 5).alias("day"), F.col("id").alias("value"), (F.col("id") % 2).alias("k"))
    for keys in ([], ["k"]):
        first = windows.lag_lead(data, "day", "value", keys)
        assert rows(first) == rows(windows.lag_lead(data.repartition(5), "day", "value", keys))
        assert rows(first) == rows(windows.lag_lead(data.orderBy(F.col("value").desc()), "day", "value", keys, bounded=True))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_chunks_are_stored_and_not_searched_for_by_every_row(spark, skewed, keys):
    chunked = windows.order_chunks(windows.with_places(skewed), ["place", "_tie", "_place"], keys)
    plan = chunked._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "Join" not in plan
    hot = chunked.where("_chunk <> -1")
    assert hot.groupBy("_chunk").count().agg(F.max("count")).first()[0] < skewed.count() / 8
