import pytest
from pyspark.sql import functions as F

from lakeops.operators import dedup, relational, skew
from lakeops.queries import QUERIES
from lakeops.queries.joins import _both_hot


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "A")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("K"), F.col("id") % 60))
        .alias("key"),
        (F.col("id") % 2).alias("part"),
    )
    right = spark.createDataFrame(
        [("A", 0, "hot"), ("A", 0, "hot twin"), ("A", 1, "hot too"), ("K1", 1, "x"), ("K4", 0, "y"), (None, 0, "n"),
         ("Z", 0, "unmatched")],
        "key string, part bigint, value string",
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("on", [["key"], ["key", "part"]])
def test_salted_join_equals_plain_join(sides, rows, how, on):
    left, right = sides
    right = right if len(on) == 2 else right.drop("part")
    left = left if len(on) == 2 else left.drop("part")
    assert skew.hot_groups(left, on)
    got = skew.salted_join(left, right, on, how)
    plain = left.join(right, on, how)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_salted_join_spreads_the_hot_key(sides):
    left, right = sides
    left = left.repartition(8)
    spread = skew.salted_join(left, right.drop("part"), ["key"], hot={**skew.hot_groups(left, ["key"])})
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_null_safe_join_matches_missing_keys(spark, rows):
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, key string")
    b = spark.createDataFrame([(None, "none"), ("x", "ex")], "key string, value string")
    got = skew.salted_join(a, b, ["key"], null_safe=True)
    assert rows(got, "id", "value") == [(1, "none"), (2, "ex")]


def test_salted_join_refuses_what_it_cannot_do(sides, spark):
    left, right = sides
    with pytest.raises(ValueError):
        skew.salted_join(left, right, ["key"], "full")
    with pytest.raises(ValueError):
        skew.salted_join(left, right.withColumn("part", F.col("part").cast("int")), ["part"])


def test_lookup_join_measures_the_right_side(sides, rows):
    left, right = sides
    right = right.drop("part")
    assert skew.fits_broadcast(right)
    assert not skew.fits_broadcast(right, max_rows=3)
    assert not skew.fits_broadcast(right, max_bytes=5)
    assert rows(skew.lookup_join(left, right, ["key"], "left")) == rows(left.join(right, ["key"], "left"))


def test_join_on_two_columns(spark, rows):
    depths = spark.createDataFrame(
        [(7, "east", 12), (7, "west", 40), (8, "east", 31), (9, None, 5)], "well int, side string, depth int"
    )
    crews = spark.createDataFrame(
        [(7, "west", "red"), (8, "east", "blue"), (8, "west", "red"), (9, None, "grey")], "well int, side string, crew string"
    )
    assert rows(skew.salted_join(depths, crews, ["well", "side"])) == [(7, "west", 40, "red"), (8, "east", 31, "blue")]
    other = crews.withColumnsRenamed({"well": "at", "side": "face"})
    got = skew.lookup_join_on(depths, other, {"well": "at", "side": "face"})
    assert rows(got, "well", "at", "face", "crew") == [(7, 7, "west", "red"), (8, 8, "east", "blue")]


def test_final_balances(spark, rows):
    moves = spark.createDataFrame(
        [("t1", "in", 7), ("t1", "out", 20), ("t1", "in", 1), ("t3", "out", 9), ("t9", "in", 5)],
        "tank string, way string, litres int",
    )
    tanks = spark.createDataFrame([("t1", 100), ("t2", 64), ("t3", 9)], "tank string, level int")
    got = relational.final_balances(tanks, "level", moves, "litres", F.col("way") == "in", "tank")
    assert rows(got, "tank", "final_balance") == [("t1", 88), ("t2", 64), ("t3", 0)]


def test_rows_whose_key_repeats(spark, rows):
    parcels = spark.createDataFrame(
        [("box", 3), ("crate", 8), ("tube", 1), ("crate", 8), ("box", 5), ("box", 3)], "kind string, weight int"
    )
    assert rows(dedup.rows_with_repeated_key(parcels, ["kind"])) == [
        ("box", 3), ("box", 3), ("box", 5), ("crate", 8), ("crate", 8)]


def test_undirected_pairs_keep_the_smaller_source(spark, rows):
    friends = spark.createDataFrame(
        [("uma", "kit"), ("kit", "uma"), ("zoe", "ivo"), ("lea", "lea"), ("kit", "ivo"), ("ivo", "zoe")],
        "source string, destination string",
    )
    assert rows(dedup.undirected_pairs(friends, "source", "destination")) == [
        ("ivo", "zoe"), ("kit", "ivo"), ("kit", "uma"), ("lea", "lea")]


def test_undirected_pairs_with_missing_ends(spark, rows):
    ends = spark.createDataFrame(
        [("a", None), (None, "a"), ("a", "a"), ("b", None), (None, None), (None, None)], "source string, destination string"
    )
    assert rows(dedup.undirected_pairs(ends, "source", "destination")) == [
        ("a", "a"), ("b", None), (None, "a"), (None, None)]


def test_mean_fill(spark, rows):
    pairs = spark.createDataFrame([(6, None), (1, 2.5), (None, 8.0), (4, 4.5)], "col1 bigint, col2 double")
    assert rows(relational.mean_fill(pairs)) == [(1.0, 2.5), (11 / 3, 8.0), (4.0, 4.5), (6.0, 5.0)]
    assert rows(relational.mean_fill(pairs, keep_type=True)) == [(1, 2.5), (3, 8.0), (4, 4.5), (6, 5.0)]
    empty = pairs.where("col1 > 9")
    assert rows(relational.mean_fill(empty)) == []


def test_present_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert relational.present_columns(df, ["b", "c"]).columns == ["b"]
    assert relational.present_columns(df, ["b", "c"], add_missing=True).columns == ["b", "c"]


def test_lookups_too_large_to_broadcast(sides, rows, monkeypatch):
    left, right = sides
    lookup = right.drop("part").dropDuplicates(["key"])
    parts = right.select("part", "value").dropDuplicates(["part"]).withColumnRenamed("value", "word")
    plain = left.join(lookup, ["key"], "left").join(parts, ["part"], "left")
    assert rows(relational.enrich(left, (lookup, "key"), (parts, "part")), "id", "part") == rows(plain, "id", "part")
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    salted = relational.enrich(left, (lookup, "key"), (parts, "part"))
    assert salted.columns == plain.columns
    assert rows(salted, "id", "part") == rows(plain, "id", "part")
    anti = skew.lookup_join(left, lookup, ["key"], "left_anti")
    assert rows(anti) == rows(left.join(lookup, ["key"], "left_anti"))


@pytest.fixture(scope="module")
def both_hot(spark):
    """Key A has a third of both sides, B of the left and C of the right only; a sixth of each has no key."""

    def side(n, own, name):
        key = (
            F.when(F.col("id") % 3 == 0, "A")
            .when(F.col("id") % 6 == 1, own)
            .when(F.col("id") % 6 == 2, None)
            .otherwise(F.concat(F.lit("K"), F.col("id") % 90))
        )
        return spark.range(n).select(key.alias("key"), F.col("id").alias(name), F.lit("x").alias(f"{name}_text"))

    return side(1200, "B", "l"), side(300, "C", "r")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_grid_join_equals_plain_join(both_hot, rows, how):
    left, right = both_hot
    got, plain = skew.grid_join(left, right, ["key"], how), left.join(right, ["key"], how)
    assert got.columns == plain.columns and rows(got) == rows(plain)


def test_grid_join_of_equal_rows_and_of_nothing(both_hot, rows):
    left, right = (df.select("key") for df in both_hot)
    assert skew.grid_join(left, right, ["key"], "left").groupBy("key").count().where("key = 'A'").first()[1] == 400 * 100
    for a, b in ((left.limit(0), right), (left, right.limit(0))):
        for how in ("inner", "left"):
            assert rows(skew.grid_join(a, b, ["key"], how)) == rows(a.join(b, ["key"], how))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_grid_join_counts_pairs_of_rows_that_are_alike(both_hot, rows, how):
    left, right = both_hot[0].withColumn("l", F.col("l") % 5), both_hot[1].withColumn("r", F.col("r") % 4)
    got, plain = skew.grid_join(left, right, ["key"], how, pairs="n"), left.join(right, ["key"], how)
    assert got.columns == [*plain.columns, "n"]
    assert rows(got) == rows(plain.groupBy(*plain.columns).agg(F.count("*").alias("n")))


@pytest.mark.parametrize("name", ["grid_join", "grid_left_join"])
def test_grid_queries_make_no_row_per_pair(spark, rows, tmp_path, name):
    """4000 orders and 3000 suppliers of one site, some twice or without a key, beside orders and suppliers without one."""
    order = F.when(F.col("id") % 7 > 0, F.col("id") * 3).alias("o_orderkey")
    orders = spark.range(4000).select(order, F.col("id").alias("o_custkey"))
    orders = orders.union(orders.limit(10)).union(spark.range(90).select("id", F.when(F.col("id") % 2 == 0, F.col("id"))))
    supplier = F.when(F.col("id") % 11 > 0, F.col("id") * 3).alias("s_suppkey")
    suppliers = spark.range(3000).select(supplier, F.when(F.col("id") % 9 > 0, F.col("id") % 9).alias("s_nationkey"))
    suppliers = suppliers.union(suppliers.limit(5)).union(spark.range(90).select("id", F.lit(1)))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    suppliers.write.parquet(f"{tmp_path}/supplier.parquet")
    a, b = _both_hot(spark, str(tmp_path))
    plain = a.join(b, ["site"], "left" if name == "grid_left_join" else "inner")
    if name == "grid_join":
        marks = F.sum(F.col("o_orderkey") % 100)
        want = plain.groupBy("site", "s_nationkey").agg(F.count(F.lit(1)).alias("pairs"), marks.alias("marks"))
    else:
        some = F.any_value("site").alias("site"), F.count("s_suppkey").alias("suppliers"), F.min("s_suppkey").alias("first_supplier")
        want = plain.where("o_orderkey is not null").groupBy("o_orderkey").agg(*some)
    got = QUERIES[name](spark, str(tmp_path))
    if name == "grid_left_join":
        got = got.where("o_orderkey is not null")  # its site may be any of several
    assert got.columns == want.columns and rows(got) == rows(want)

    def most_rows(df):
        df.collect()
        plan, most = [df._jdf.queryExecution().executedPlan()], 0
        while plan:
            node = plan.pop()
            found = node.metrics().get("numOutputRows")
            most = max(most, found.get().value() if found.isDefined() else 0)
            nodes = [node.executedPlan()] if "AdaptiveSparkPlan" in node.nodeName() else []
            nodes += [node.plan()] if "QueryStage" in node.nodeName() else []
            plan += nodes + [node.children().apply(i) for i in range(node.children().size())]
        return most

    # The plain join makes more than nine million.
    assert 0 < most_rows(QUERIES[name](spark, str(tmp_path))) < 100_000


def test_grid_cells_are_alike(both_hot):
    # As many cells as asked for; the larger side is cut into more pieces.
    assert skew._cells(1000, 1000, 16) == (4, 4)
    assert skew._cells(64_000, 1000, 16) == (16, 1)
    assert skew._cells(1, 1000, 8) == (1, 8)
    left, right = both_hot
    cells = skew.grid_join(left, right, ["key"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_grid_row" in cells and "_grid_column" in cells
