from pyspark.sql import functions as F

from lakeops.functions.masking import mask_fields
from lakeops.operators import nested, text
from lakeops.sources.readers import read_json


def test_word_counts_fold_case(spark, rows):
    lines = spark.createDataFrame([("Rain on tin",), ("tin roof",), ("RAIN stops and rain starts",)], "line string")
    counts = dict(rows(text.word_counts(lines, "line")))
    assert counts["rain"] == 3 and counts["tin"] == 2 and counts["roof"] == 1 and len(counts) == 7


def test_top_words_with_and_without_case(spark):
    lines = spark.createDataFrame([("Owl owl moth",), ("Moth Owl Fox",), ("Owl moth",)], "text string")
    assert [tuple(r) for r in text.top_words(lines, "text", 2).collect()] == [("owl", 4), ("moth", 3)]
    assert [tuple(r) for r in text.top_words(lines, "text", 2, fold_case=False).collect()] == [("Owl", 3), ("moth", 2)]


def test_members_per_element(spark, rows):
    choirs = spark.createDataFrame(
        [("ida", ["alto", "alto"]), ("jon", ["bass", "alto"]), ("kay", []), ("lou", ["bass", "tenor", "alto"])],
        "singer string, voices array<string>",
    )
    assert rows(text.members_per_element(choirs, "singer", F.col("voices"))) == [("alto", 3), ("bass", 2), ("tenor", 1)]


def test_masks_keep_missing_values(spark, rows):
    accounts = spark.createDataFrame(
        [("q", "900-70-5528", "6011000990139424"), ("r", None, "3530111333300000"), ("s", "987-65-4320", None)],
        "owner string, ssn string, card_number string",
    )
    assert rows(mask_fields(accounts, ["ssn", "card_number", "owner"])) == [
        ("q", "***-**-5528", "**** **** **** 9424"),
        ("r", None, "**** **** **** 0000"),
        ("s", "***-**-4320", None),
    ]


LISTING = """[{"code": "1", "results_found": 3, "restaurants": [
  {"restaurant": {"id": "1", "name": "Oak", "cuisines": "", "deeplink": "z://1", "location": {"city": "Columbus"},
    "user_rating": {"rating_text": "Good"}, "establishment_types": ["Bar", "Cafe"]}},
  {"restaurant": {"id": "2", "name": "Elm", "cuisines": "Thai", "deeplink": "z://2", "location": {"city": "Columbus"},
    "user_rating": {"rating_text": "Excellent"}, "establishment_types": []}},
  {"restaurant": {"id": "3", "name": "", "cuisines": "", "deeplink": "z://3", "location": {"city": "Dayton"},
    "user_rating": {"rating_text": "Poor"}, "establishment_types": ["Bar"]}}]}]"""


def test_listing_is_flattened_from_multi_line_json(spark, rows, tmp_path):
    (tmp_path / "listing.json").write_text(LISTING)
    listing = read_json(spark, str(tmp_path / "listing.json"), multi_line=True)
    flat = nested.flatten_listing(listing)
    assert rows(flat, "restaurant_id", "ratings", "city") == [
        ("1", "Good", "Columbus"), ("2", "Excellent", "Columbus"), ("3", "Poor", "Dayton")]
    coded = nested.with_rating_code(nested.per_establishment(flat))
    assert rows(coded, "restaurant_id", "establishment_type", "rating") == [
        ("1", "Bar", 2), ("1", "Cafe", 2), ("2", None, 4), ("3", "Bar", -1)]
    # Counts rows per establishment, so the first restaurant counts twice.
    assert rows(nested.ratings_in_city(listing, "Columbus")) == [("Excellent", 1), ("Good", 2)]
    by_id = [flat.select("restaurant_id", c) for c in ("restaurant_name", "ratings", "cuisines")]
    assert rows(nested.named_without_cuisine(*by_id)) == [("Good", 1)]
    twice = [part.union(part) for part in by_id]
    assert rows(nested.named_without_cuisine(*twice)) == [("Good", 8)]


def test_explode_and_flatten(spark, rows):
    people = spark.createDataFrame(
        [("tray", [["nut", "bolt"], [], ["washer"]])], "name string, skills array<array<string>>"
    )
    assert people.select(F.explode("skills")).count() == 3
    assert rows(people.select(F.flatten("skills"))) == [(["nut", "bolt", "washer"],)]


def test_sketches_add_up_over_parts(spark):
    from lakeops.operators import text

    data = spark.range(20_000).select(
        F.col("id").alias("member"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("even"), F.lit("all"))).otherwise(F.array(F.lit("all"))).alias("marks"),
        (F.col("id") % 3).alias("day"),
    )
    again = data.where("member < 9000").withColumn("day", F.lit(9).cast("bigint"))  # known members in a later part
    sketches = text.member_sketches(data, "member", F.col("marks"), "day").union(
        text.member_sketches(again, "member", F.col("marks"), "day")
    )
    assert sketches.count() == 8
    found = {r.element: r.members for r in text.members_from_sketches(sketches).collect()}
    assert abs(found["all"] - 20_000) < 600 and abs(found["even"] - 10_000) < 300
    assert text.members_from_sketches(sketches.limit(0)).count() == 0
