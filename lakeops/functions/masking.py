"""Masking of personal fields."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The masked part of a social security number and of a card number.
SSN_HEAD = r"\d{3}-\d{2}"
SSN_MASK = "***-**"
CARD_MASK = "**** **** **** "


def mask_ssn(value: Column) -> Column:
    return F.regexp_replace(value, SSN_HEAD, SSN_MASK)


def mask_card(value: Column) -> Column:
    """Keep the last four characters; a missing number stays missing, since concat passes null on."""
    return F.concat(F.lit(CARD_MASK), value.substr(-4, 4))


MASKS: dict[str, Callable[[Column], Column]] = {"ssn": mask_ssn, "card_number": mask_card}


def mask_fields(df: DataFrame, fields: Iterable[str], masks: dict | None = None) -> DataFrame:
    """Mask the named columns; names without a mask are left as they are."""
    masks = MASKS if masks is None else masks
    return df.withColumns({name: masks[name](F.col(name)) for name in fields if name in masks})
