"""What each filter of a chain removes, for every order of the filters.

Each document becomes a mask with a bit per filter that it fails, and documents are counted by part and mask: these few
cells are all that the orders need. A recursive query then extends every prefix of filters by each filter that it does not
hold yet, carrying the bits already applied, and each level of the recursion gives that step's counts from the cells.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.columns import spaced_words
from lakeops.session import materialize

#: The letter of the filter for copies; it is the last one.
COPIES = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """When a text fails each filter: few words, few different words, many capitals, symbols."""
    words = spaced_words(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``key``, ``part`` and ``mask`` of every row: bit i is set if it fails the i-th filter.

    The last filter is failed by copies: rows whose whole text stands under a smaller key, in any part. Null texts and
    parts are empty ones; a missing key is larger than all others; rows that share the smallest key stay. Texts are
    compared by their SHA-256.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), whole.alias("text")
    )
    filters = text_filters(F.col("text"))
    bits = [F.when(fails, F.lit(1 << place)).otherwise(F.lit(0)) for place, fails in enumerate(filters.values())]
    mask = sum(bits[1:], bits[0])
    # Stored, so that texts are read once and joins of hot copies can be split.
    seen = materialize(rows.select("key", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "audit-rows")
    groups = seen.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    copied = materialize(groups.where("n > 1").select("digest", "first"), "audit-copies")
    copy = F.col("first").isNotNull() & F.coalesce(F.col("key") > F.col("first"), F.lit(True))
    return seen.join(copied, "digest", "left").select(
        "key", "part", (F.col("mask") + F.when(copy, F.lit(1 << len(filters))).otherwise(F.lit(0))).alias("mask")
    )


def mask_cells(rows: DataFrame, labels: DataFrame, key: str = "doc_id", marks: Mapping[str, str] | None = None) -> DataFrame:
    """``part``, ``mask``, ``n`` and how many rows have each mark of ``labels`` (``good``, ``toxic``), as counts.

    A row has a mark if any label row of its key does; rows without a key have none.
    """
    marks = marks or {"good": "quality", "toxic": "toxic"}
    marked = labels.select(F.col(f"`{key}`").alias("key"), *[(F.col(f"`{c}`") == 1).alias(name) for name, c in marks.items()])
    marked = marked.where(F.col("key").isNotNull()).groupBy("key").agg(*[F.max(name).alias(name) for name in marks])
    joined = rows.join(materialize(marked, "audit-marks"), "key", "left")
    counts = [F.count_if(F.coalesce(F.col(name), F.lit(False))).alias(name) for name in marks]
    return joined.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *counts)


_STEPS = """
WITH RECURSIVE steps(part, cells, filter_order, applied, step, letter, kept, removed, redundant, unique_fails,
                     good_lost, toxic_lost) AS (
  SELECT part, cells, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L FROM {parts}
  UNION ALL
  SELECT s.part, s.cells, concat(s.filter_order, f.name), s.applied | f.bit, s.step + 1, f.name,
         aggregate(s.cells, 0L, (a, c) -> a + if(c.mask & (s.applied | f.bit) = 0, c.n, 0L)),
         aggregate(s.cells, 0L, (a, c) -> a + if(c.mask & s.applied = 0 AND c.mask & f.bit <> 0, c.n, 0L)),
         aggregate(s.cells, 0L, (a, c) -> a + if(c.mask & s.applied <> 0 AND c.mask & f.bit <> 0, c.n, 0L)),
         aggregate(s.cells, 0L, (a, c) -> a + if(c.mask = f.bit, c.n, 0L)),
         aggregate(s.cells, 0L, (a, c) -> a + if(c.mask & s.applied = 0 AND c.mask & f.bit <> 0, c.good, 0L)),
         aggregate(s.cells, 0L, (a, c) -> a + if(c.mask & s.applied = 0 AND c.mask & f.bit <> 0, c.toxic, 0L))
  FROM steps s JOIN {filters} f ON s.applied & f.bit = 0
)
SELECT part, filter_order, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost
FROM steps LIMIT ALL
"""


def order_steps(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """A row per part, order of all filters and step, with that step's counts and its filter's ``shapley`` number.

    ``shapley`` is what the filter removes, added up over all orders. ``cells`` are those of :func:`mask_cells`; a part
    has as many as there are masks, so its cells fit a row. No cells give no rows.
    """
    spark = cells.sparkSession
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    # Stored, as each level of the recursion reads the parts again.
    parts = materialize(packed, "audit-cells")
    names = [F.struct(F.lit(name).alias("name"), F.lit(1 << place).alias("bit")) for place, name in enumerate(letters)]
    filters = spark.range(0, 1, 1, 1).select(F.inline(F.array(*names)))
    steps = materialize(spark.sql(_STEPS, parts=parts, filters=filters).where("step > 0"), "audit-steps")
    # A step stands in as many orders as the filters after it have.
    orders = F.factorial(F.lit(len(letters)) - F.col("step"))
    shapley = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    whole = steps.where(F.col("step") == len(letters)).select(
        "part", F.col("filter_order").alias("order"), F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")
    )
    prefixes = whole.withColumn("filter_order", F.expr("left(order, step)"))
    found = prefixes.join(steps, ["part", "filter_order", "step"]).join(shapley, ["part", "letter"])
    return found.select(
        "part", F.col("order").alias("filter_order"), "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley",
    )


def interaction_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The filters of :func:`text_filters` and the one for copies, in all orders, over every part of ``docs``.

    See :func:`masked` for nulls and copies; repeated rows count each, and an empty table gives no rows. Labels without a
    document change nothing, and clashing names of other columns do not matter.
    """
    letters = "".join(text_filters(F.lit(""))) + COPIES
    return order_steps(mask_cells(masked(docs, key, text, part), labels, key), letters)
