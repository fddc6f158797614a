"""Predicates that rules and checks are built from."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(value: Column) -> Column:
    """Missing, or nothing but spaces."""
    return value.isNull() | (F.trim(value) == "")


def not_matching(value: Column, pattern: str, null_fails: bool) -> Column:
    differs = ~value.rlike(pattern)
    return differs | value.isNull() if null_fails else differs


def outside(value: Column, low=None, high=None) -> Column | None:
    """Below ``low`` or above ``high``; None if there is no bound."""
    bounds = []
    if low is not None:
        bounds.append(value < low)
    if high is not None:
        bounds.append(value > high)
    return reduce(Column.__or__, bounds) if bounds else None


def all_present(names: Sequence[str]) -> Column:
    """True where every named column has a value; true for no names."""
    return reduce(Column.__and__, [F.col(name).isNotNull() for name in names], F.lit(True))


def true_only(condition: Column) -> Column:
    """The condition with unknown counted as false."""
    return F.coalesce(condition, F.lit(False))
