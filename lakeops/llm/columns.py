"""Column helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The ASCII white space that separates words.
SPACES = "\t\n\x0b\f\r"


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or with underscores added until no column of ``df`` has that name (names are not case-sensitive)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


#: The same characters and the blank as a regular expression.
SPACE_CLASS = r"[ \t\n\x0B\f\r]+"


def spaced_words(text: Column) -> Column:
    """The words between ASCII white space."""
    return F.array_remove(F.split(text, SPACE_CLASS), "")
