"""Flattening of nested JSON listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.change import rating_code

# Paths inside one listing entry.
LISTING_PATHS = {
    "restaurant_id": "restaurant.id",
    "restaurant_name": "restaurant.name",
    "cuisines": "restaurant.cuisines",
    "ratings": "restaurant.user_rating.rating_text",
    "city": "restaurant.location.city",
    "deeplink": "restaurant.deeplink",
}


def flatten_listing(listing: DataFrame) -> DataFrame:
    """One row per listed restaurant, from a single explode; only the paths in use are read."""
    entries = listing.select(F.explode("restaurants").alias("entry"))
    return entries.select(
        *[F.col(f"entry.{path}").alias(name) for name, path in LISTING_PATHS.items()],
        F.col("entry.restaurant.establishment_types").alias("establishment_types"),
    )


def per_establishment(restaurants: DataFrame) -> DataFrame:
    """One row per restaurant and establishment type; restaurants without a type stay."""
    return restaurants.withColumn("establishment_type", F.explode_outer("establishment_types")).drop(
        "establishment_types"
    )


def with_rating_code(restaurants: DataFrame) -> DataFrame:
    return restaurants.withColumn("rating", rating_code(F.col("ratings")))


def ratings_in_city(listing: DataFrame, city: str) -> DataFrame:
    """Establishment rows per rating text in one city."""
    rows = per_establishment(flatten_listing(listing)).where(F.col("city") == city)
    return rows.groupBy("ratings").agg(F.count(F.lit(1)).alias("restaurant_ratings"))


def named_without_cuisine(names: DataFrame, ratings: DataFrame, cuisines: DataFrame) -> DataFrame:
    """Restaurants per rating that have a name but an empty cuisine, from three tables keyed by id.

    Counts what a join of the three tables gives. Each table is counted per id before it is joined, so an
    id that occurs often on every side is multiplied as numbers, not as rows.
    """
    key, one = "restaurant_id", F.count(F.lit(1))
    named = names.where(F.col("restaurant_name") != "").groupBy(key).agg(one.alias("_named"))
    rated = ratings.groupBy(key, "ratings").agg(one.alias("_rated"))
    without = cuisines.where(F.col("cuisines") == "").groupBy(key).agg(one.alias("_without"))
    joined = named.join(rated, key, "left").join(without, key, "inner")
    rows = F.col("_named") * F.coalesce("_rated", F.lit(1)) * F.col("_without")
    return joined.groupBy("ratings").agg(F.sum(rows).alias("restaurants"))
