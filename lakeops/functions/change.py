"""Changes between consecutive values, and codes for rating words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code of each rating word; any other word, or none, is -1.
RATING_CODES = {"Excellent": 4, "Very Good": 3, "Good": 2, "Average": 1}
NO_RATING = -1


def percent_change(current: Column, previous: Column, base: str = "current") -> Column:
    """``(current - previous) / base * 100``; null where the base is zero or a value is missing."""
    if base not in ("current", "previous"):
        raise ValueError("base is 'current' or 'previous'")
    return F.try_divide(current - previous, current if base == "current" else previous) * 100


def as_percent_text(value: Column, digits: int | None = None) -> Column:
    shown = value if digits is None else F.round(value, digits)
    return F.concat(shown.cast("string"), F.lit("%"))


def number_from_text(text: Column) -> Column:
    """Number written with thousands separators; null where it is none."""
    return F.regexp_replace(text, ",", "").try_cast("double")


def rating_code(text: Column) -> Column:
    code = F.lit(NO_RATING)
    for word, number in RATING_CODES.items():
        code = F.when(text == word, F.lit(number)).otherwise(code)
    return code
