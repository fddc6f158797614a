"""Words, masks and nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.masking import mask_fields
from lakeops.operators import nested, text
from lakeops.queries.registry import query, table
from lakeops.session import parallelism, work_dir
from lakeops.sources.readers import read_products, read_with_floor


@query(
    "distinct_members",
    """
    SELECT element, count(DISTINCT p_partkey) AS members
    FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS element FROM part) GROUP BY element
    """,
)
def distinct_members(spark, sf):
    return text.members_per_element(table(spark, sf, "part"), "p_partkey", F.split("p_name", " "))


@query(
    "distinct_members_sketch",
    """
    SELECT element, count(DISTINCT l_orderkey) AS members, true AS within_error FROM (
      SELECT l_orderkey, unnest([l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR)]) AS element FROM lineitem
    ) WHERE element IS NOT NULL GROUP BY element
    """,
)
def distinct_members_sketch(spark, sf):
    """Orders per mark of their lines, from stored sketches of two batches that share orders, beside the exact numbers."""
    marks = F.array_compact(F.array("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")))
    lines = table(spark, sf, "lineitem").select("l_orderkey", marks.alias("marks"), F.col("l_quantity").alias("quantity"))
    lines = lines.withColumn("batch", F.when(F.col("quantity") > 25, "late").otherwise("early"))
    path = work_dir(spark, "sketches")
    for batch in ("early", "late"):
        arrived = lines.where(F.col("batch") == batch)
        text.member_sketches(arrived, "l_orderkey", F.col("marks"), "batch").write.mode("append").parquet(path)
    about = text.members_from_sketches(spark.read.parquet(path)).withColumnRenamed("members", "about")
    exact = text.members_per_element(lines, "l_orderkey", F.col("marks"))
    # Four standard errors, and one for rounding.
    allowed = 1 + 4 * 0.83 / 2 ** (text.SKETCH_BITS / 2) * F.col("members")
    close = F.abs(F.col("about") - F.col("members")) <= allowed
    return exact.join(about, "element", "left").select("element", "members", F.coalesce(close, F.lit(False)).alias("within_error"))


@query(
    "word_count",
    """
    SELECT word, count(*) AS freq
    FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) GROUP BY word
    """,
)
def word_count(spark, sf):
    return text.word_counts(_documents(spark, sf), "text")


@query(
    "top_words",
    """
    SELECT word, count(*) AS freq
    FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) GROUP BY word
    ORDER BY freq DESC, word LIMIT 5
    """,
)
def top_words(spark, sf):
    return text.top_words(_documents(spark, sf), "text")


@query(
    "top_words_case_sensitive",
    """
    SELECT word, count(*) AS freq
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word
    ORDER BY freq DESC, word LIMIT 5
    """,
)
def top_words_case_sensitive(spark, sf):
    return text.top_words(_documents(spark, sf), "text", fold_case=False)


def _documents(spark, sf):
    """Documents in at least as many partitions as a shuffle has; large inputs have that many by themselves."""
    path = f"{sf.rstrip('/')}/documents.parquet"
    return read_with_floor(spark, path, min_partitions=parallelism(spark)).select("text")


@query(
    "explode_nested",
    """
    SELECT conv_id, turn, len(string_split(line, ' ')) AS words, line
    FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations)
    """,
)
def explode_nested(spark, sf):
    """An array of word arrays per message: one row per inner array."""
    return (
        _word_lists(table(spark, sf, "conversations"))
        .select("conv_id", "turn", F.explode("lists").alias("list"))
        .select(
            "conv_id", "turn", F.size("list").cast("bigint").alias("words"), F.array_join("list", " ").alias("line")
        )
    )


@query(
    "explode_flatten",
    """
    SELECT conv_id, turn, word, count(*) AS times
    FROM (
      SELECT conv_id, turn, unnest(string_split(line, ' ')) AS word
      FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations)
    ) GROUP BY ALL
    """,
)
def explode_flatten(spark, sf):
    """The same arrays made into one per message, then counted."""
    flat = _word_lists(table(spark, sf, "conversations")).select("conv_id", "turn", F.flatten("lists").alias("words"))
    exploded = flat.select("conv_id", "turn", F.explode("words").alias("word"))
    return exploded.groupBy("conv_id", "turn", "word").agg(F.count(F.lit(1)).alias("times"))


def _word_lists(conversations):
    lists = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    return conversations.select("conv_id", "turn", lists.alias("lists"))


@query(
    "mask_fields",
    """
    WITH people AS (
      SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL
        ELSE substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 1, 3) || '-' ||
             substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 4, 2) || '-' ||
             substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 6, 4) END AS ssn,
        CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
        ELSE lpad(CAST(c_custkey AS VARCHAR), 16, '4') END AS card_number
      FROM customer
    )
    SELECT c_custkey, regexp_replace(ssn, '[0-9]{3}-[0-9]{2}', '***-**', 'g') AS ssn,
           '**** **** **** ' || right(card_number, 4) AS card_number
    FROM people
    """,
)
def mask(spark, sf):
    digits = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    ssn = F.concat_ws("-", digits.substr(1, 3), digits.substr(4, 2), digits.substr(6, 4))
    people = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, ssn).alias("ssn"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.lpad(F.col("c_custkey").cast("string"), 16, "4")).alias(
            "card_number"
        ),
    )
    return mask_fields(people, ["ssn", "card_number"])


# Words and sizes that make listings out of parts.
LISTING_SQL = """
    WITH listed AS (
      SELECT p_partkey * 10 + i AS restaurant_id, p_name AS restaurant_name,
             CASE WHEN p_size > 40 THEN '' ELSE p_type END AS cuisines,
             CASE p_type WHEN 'STANDARD' THEN 'Excellent' WHEN 'SMALL' THEN 'Very Good' WHEN 'MEDIUM' THEN 'Good'
               WHEN 'LARGE' THEN 'Average' ELSE 'Not rated' END AS ratings,
             p_brand AS city,
             CASE WHEN p_size < 5 THEN NULL ELSE string_split(p_name, ' ') END AS types
      FROM (SELECT *, unnest(generate_series(1, CASE WHEN p_size > 30 THEN 3 WHEN p_size > 10 THEN 2 ELSE 1 END)) AS i
            FROM part)
    ),
    flat AS (
      SELECT * EXCLUDE (types), unnest(CASE WHEN types IS NULL THEN [NULL] ELSE types END) AS establishment_type
      FROM listed
    )
"""


def _listing(spark, sf):
    """Nested JSON written from ``part``: one document per part, with one to three restaurants each."""
    words = {"STANDARD": "Excellent", "SMALL": "Very Good", "MEDIUM": "Good", "LARGE": "Average"}
    rating = F.lit("Not rated")
    for kind, word in words.items():
        rating = F.when(F.col("p_type") == kind, word).otherwise(rating)

    def restaurant(i):
        return F.struct(
            F.struct(
                (F.col("p_partkey") * 10 + i).alias("id"),
                F.col("p_name").alias("name"),
                F.when(F.col("p_size") > 40, F.lit("")).otherwise(F.col("p_type")).alias("cuisines"),
                F.concat(F.lit("app://"), F.col("p_brand")).alias("deeplink"),
                F.struct(rating.alias("rating_text")).alias("user_rating"),
                F.struct(F.col("p_brand").alias("city")).alias("location"),
                F.when(F.col("p_size") >= 5, F.split("p_name", " ")).alias("establishment_types"),
            ).alias("restaurant")
        )

    branches = F.when(F.col("p_size") > 30, 3).when(F.col("p_size") > 10, 2).otherwise(1)
    many = F.transform(F.sequence(F.lit(1), branches), restaurant)
    path = work_dir(spark, "listing")
    table(spark, sf, "part").select(
        F.lit("200").alias("code"), F.size(many).alias("results_found"), many.alias("restaurants")
    ).write.json(path)
    schema = (
        "code string, results_found int, restaurants array<struct<restaurant: struct<id: bigint, name: string, "
        "cuisines: string, deeplink: string, user_rating: struct<rating_text: string>, "
        "location: struct<city: string>, establishment_types: array<string>>>>"
    )
    return spark.read.schema(schema).json(path)


@query(
    "json_flatten",
    LISTING_SQL
    + """
    SELECT restaurant_id, restaurant_name, cuisines, ratings, city, 'app://' || city AS deeplink, establishment_type
    FROM flat
    """,
)
def json_flatten(spark, sf):
    return nested.per_establishment(nested.flatten_listing(_listing(spark, sf)))


@query(
    "json_declared_schema",
    """
    SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title, p_retailprice AS price, p_size AS stock,
           CASE WHEN p_size > 5 THEN p_brand END AS brand, p_type AS category,
           CAST(len(string_split(p_name, ' ')) AS INTEGER) AS images
    FROM part
    """,
)
def json_declared_schema(spark, sf):
    """Parts as landed product payloads, read with the declared schema; unknown fields are left out."""
    path = work_dir(spark, "products")
    table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("brand"),
        F.col("p_type").alias("category"),
        F.split("p_name", " ").alias("images"),
        F.lit("x").alias("warranty"),
    ).write.json(path)
    products = read_products(spark, path)
    return products.select(
        "id", "title", "price", "stock", "brand", "category", F.size("images").alias("images")
    )


@query(
    "json_rating_case",
    LISTING_SQL
    + """
    SELECT CAST(CASE ratings WHEN 'Excellent' THEN 4 WHEN 'Very Good' THEN 3 WHEN 'Good' THEN 2 WHEN 'Average' THEN 1
             ELSE -1 END AS INTEGER) AS rating, count(*) AS establishments
    FROM flat GROUP BY ALL
    """,
)
def json_rating_case(spark, sf):
    rows = nested.with_rating_code(nested.per_establishment(nested.flatten_listing(_listing(spark, sf))))
    return rows.groupBy("rating").agg(F.count(F.lit(1)).alias("establishments"))


@query(
    "json_ratings_in_city",
    LISTING_SQL + "SELECT ratings, count(*) AS restaurant_ratings FROM flat WHERE city = 'Brand#2' GROUP BY ratings",
)
def json_ratings_in_city(spark, sf):
    return nested.ratings_in_city(_listing(spark, sf), "Brand#2")


@query(
    "json_three_tables",
    LISTING_SQL
    + """
    SELECT ratings, count(*) AS restaurants FROM listed WHERE restaurant_name <> '' AND cuisines = '' GROUP BY ratings
    """,
)
def json_three_tables(spark, sf):
    rows = nested.flatten_listing(_listing(spark, sf))
    return nested.named_without_cuisine(
        rows.select("restaurant_id", "restaurant_name"),
        rows.select("restaurant_id", "ratings"),
        rows.select("restaurant_id", "cuisines"),
    )
