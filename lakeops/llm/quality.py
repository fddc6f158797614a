"""Quality rules whose cutoffs are certified on labelled rows.

Each document gets counts, from these a badness score between 0 and 1, and each stratum a cutoff for it. A cutoff is
certified if an exact binomial test on the labelled good documents of the stratum rejects "more than ``risk`` of the
good documents would be lost". Cutoffs are tested from the loosest to the strictest and testing stops at the first that
fails, so the tests of one stratum need no correction between them; ``delta`` is divided by the number of strata. With
probability ``1 - delta`` no stratum then loses more than ``risk`` of its good documents. Of the certified cutoffs the
one that best parts bad from good is used, the loosest of equals; a stratum without any loses nothing beyond the base
rules. Everything is DataFrame work: counts are taken inside each row, the test is one row per stratum and cutoff.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.llm.columns import SPACE_CLASS, SPACES, free_name, spaced_words
from lakeops.operators.skew import fits_broadcast
from lakeops.session import materialize

#: The characters that count as symbols.
SYMBOLS = "[#*$%&|<>]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Parameters. ``cutoffs`` run from the loosest to the strictest."""

    min_words: int = 50
    max_repeat_pct: int = 50
    risk: float = 0.05
    delta: float = 0.05
    cutoffs: tuple[float, ...] = tuple(round(1 - 0.05 * i, 2) for i in range(1, 19))


def _without(text: Column, pattern: str) -> Column:
    """The code points of the text that lie in no match."""
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")


def measured(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with a struct column of counts and the badness score of each whole text.

    Null and empty texts have no words: all counts are 0 and the badness is 0. ``n_repeat_words`` counts the words that
    lie in three-word windows found twice or more in the text: the hash of each window is packed with its place into one
    long, the longs are sorted, and neighbours of equal hash whose words are equal, too, are windows found again. Next
    neighbours but one are compared as well, so one other window of the same hash between two equal ones does no harm.
    """
    names = {n: free_name(df, f"_{n}") for n in (
        "text", "words", "n", "bits", "windows", "found", "lines", "distinct", "length", "chars", "symbols", "marks",
        "capitals",
    )}
    raw, words, n, bits, windows, found, lines, distinct, length, chars, symbols, marks, capitals = (F.col(f"`{name}`") for name in names.values())
    step1 = df.withColumn(names["text"], F.coalesce(F.col(f"`{text}`"), F.lit("")))
    step2 = step1.withColumns(
        {
            names["words"]: spaced_words(raw),
            names["lines"]: F.filter(F.split(raw, "\n"), lambda line: F.trim(line, F.lit(SPACES + " ")) != ""),
            names["length"]: F.char_length(raw).cast("long"),
            names["chars"]: _without(raw, SPACE_CLASS),
            names["symbols"]: _without(raw, SYMBOLS),
            names["marks"]: _without(raw, "!+"),
            names["capitals"]: _without(raw, "[A-Z]+"),
        }
    )
    step2 = step2.withColumns(
        {
            names["n"]: F.size(words),
            names["distinct"]: F.size(F.array_distinct(lines)),
            names["symbols"]: length - symbols,
            names["marks"]: length - marks,
            names["capitals"]: length - capitals,
        }
    )
    # Bits that the largest place in the text needs.
    step2 = step2.withColumn(names["bits"], F.length(F.bin(n.cast("long"))))
    step3 = step2.withColumn(
        names["windows"],
        F.when(
            n >= 3,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), n - 3),
                    lambda i: F.call_function(
                        "shiftleft", F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), bits
                    ).bitwiseOR(i.cast("long")),
                )
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def same(x: Column, y: Column) -> Column:
        # Null, so not kept, beyond the ends; words are looked at only where hashes are equal.
        hashes = F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0
        one, other = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
        equal = [F.get(words, one + i) == F.get(words, other + i) for i in range(3)]
        return F.when(hashes, equal[0] & equal[1] & equal[2]).otherwise(F.lit(False))

    again = F.filter(
        windows,
        lambda x, j: same(x, F.get(windows, j + 1))
        | same(x, F.get(windows, j - 1))
        | same(x, F.get(windows, j + 2))
        | same(x, F.get(windows, j - 2)),
    )
    step4 = step3.withColumn(names["found"], F.sort_array(F.transform(again, lambda x: x.bitwiseAND(mask))))
    covered = F.aggregate(
        F.transform(found, lambda x, j: F.least(F.lit(3).cast("long"), F.coalesce(F.get(found, j + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    repeated_lines = (F.size(lines) - distinct).cast("long")

    def share(part: Column, whole: Column) -> Column:
        return F.least(F.lit(1.0), F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0)))

    counted = step4.withColumn(
        into,
        F.struct(
            n.cast("long").alias("n_words"),
            chars.alias("word_chars"),
            symbols.alias("n_symbols"),
            repeated_lines.alias("n_dup_lines"),
            covered.alias("n_repeat_words"),
            F.greatest(
                share(symbols, n), share(marks, n), share(capitals, chars), share(repeated_lines, F.size(lines)) / 2
            ).alias("badness"),
        ),
    )
    return counted.drop(*names.values())


def base_failed(counts: str, rules: Rules) -> Column:
    words, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (words < rules.min_words) | (100 * repeated > rules.max_repeat_pct * words)


def _log_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series at n + 9, divided down by the eight factors between."""
    x = n.cast("double") + 9
    series = (
        (x - 0.5) * F.log(x)
        - x
        + F.lit(0.9189385332046727)  # ln(2 pi) / 2
        + 1 / (12 * x)
        - 1 / (360 * x * x * x)
        + 1 / (1260 * x * x * x * x * x)
    )
    for i in range(1, 9):
        series = series - F.log(n.cast("double") + i)
    return series


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p).

    The terms are summed downwards from k, each from the one above it; those beyond 12 standard deviations are below
    what a double can add.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = F.exp(
        _log_factorial(n)
        - _log_factorial(k)
        - _log_factorial(n - k)
        + kd * F.log(F.lit(p))
        + (nd - kd) * F.log(F.lit(1 - p))
    )
    steps = F.sequence(F.lit(0).cast("long"), F.least(k.cast("long"), F.ceil(12 * F.sqrt(nd)) + 60))
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
    ratio = (1 - p) / p
    total = F.aggregate(
        steps,
        zero,
        lambda acc, j: F.struct(
            (acc["term"] * (kd - j) * F.lit(ratio) / (nd - kd + j + 1)).alias("term"),
            (acc["total"] + acc["term"]).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    return F.least(F.lit(1.0), top * total)


def certified_cutoffs(labelled: DataFrame, rules: Rules) -> DataFrame:
    """(stratum, cutoff) for strata with a certified cutoff.

    ``labelled`` has ``stratum``, ``badness`` and ``good``; rows with a null label are left out, a null stratum is a
    stratum of its own. One aggregation counts all cutoffs of a stratum, so a stratum may hold any share of the rows.
    """
    rows = labelled.filter(F.col("good").isNotNull())
    counts = rows.groupBy("stratum").agg(
        F.count_if(F.col("good")).alias("n"),
        F.count_if(~F.col("good")).alias("n_bad"),
        F.array(*[F.count_if(F.col("good") & (F.col("badness") > c)) for c in rules.cutoffs]).alias("lost"),
        F.array(*[F.count_if(~F.col("good") & (F.col("badness") > c)) for c in rules.cutoffs]).alias("caught"),
    )
    strata = counts.groupBy().agg(F.count("*").alias("strata"))
    tests = (
        counts.crossJoin(F.broadcast(strata))  # one row
        .select("stratum", "n", "n_bad", "strata", F.posexplode(F.arrays_zip("lost", "caught")).alias("place", "x"))
        .withColumn("cutoff", F.get(F.array(*map(F.lit, rules.cutoffs)), F.col("place")))
        .withColumn("passed", binomial_tail(F.col("x.lost"), F.col("n"), rules.risk) <= rules.delta / F.col("strata"))
        .withColumn("gain", F.try_divide("x.caught", "n_bad") - F.try_divide("x.lost", "n"))
    )
    so_far = Window.partitionBy("stratum").orderBy("place")
    return (
        tests.withColumn("certified", F.min(F.col("passed").cast("int")).over(so_far) == 1)
        .filter(F.col("certified") & (F.coalesce(F.col("gain"), F.lit(0.0)) > 0))
        .groupBy("stratum")
        .agg(F.max_by("cutoff", F.struct("gain", "cutoff")).alias("cutoff"))
    )


def with_verdict(df: DataFrame, counts: str, stratum: str, cutoffs: DataFrame, rules: Rules, failed: str, kept: str):
    """``df`` with two more columns: whether the base rules failed, and whether the row is kept."""
    place, cutoff = free_name(df, "_stratum"), free_name(df, "_cutoff")
    bounds = cutoffs.select(F.col("stratum").alias(place), F.col("cutoff").alias(cutoff))
    joined = df.join(bounds, F.col(f"`{stratum}`").eqNullSafe(F.col(place)), "left")
    passes = F.col(cutoff).isNull() | (F.col(f"{counts}.badness") <= F.col(cutoff))
    return (
        joined.withColumn(failed, base_failed(counts, rules))
        .withColumn(kept, ~F.col(failed) & passes)
        .drop(place, cutoff)
    )


def _labelled(measures: DataFrame, labels: DataFrame, key: str, stratum: str, counts: str, rules: Rules) -> DataFrame:
    """Labelled rows that pass the base rules; labels that contradict each other count as bad."""
    marks = (
        labels.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_labelled"))
        .agg((F.min("quality") == 1).alias("good"))
    )
    return (
        measures.filter(~base_failed(counts, rules))
        .join(marks, F.col(f"`{key}`") == F.col("_labelled"))
        .select(F.col(f"`{stratum}`").alias("stratum"), F.col(f"{counts}.badness").alias("badness"), "good")
    )


def quality_report(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of ``docs`` (doc_id, text, lang; more columns are ignored).

    The counts are taken once and stored without texts. Repeated rows are judged each, a null doc_id has no label, an
    empty table gives an empty result.
    """
    measures = materialize(
        measured(docs.select("doc_id", "lang", "text"), "text", "counts").drop("text"), "quality-counts"
    )
    cutoffs = materialize(
        certified_cutoffs(_labelled(measures, labels, "doc_id", "lang", "counts", rules), rules), "quality-cutoffs"
    )
    judged = with_verdict(measures, "counts", "lang", cutoffs, rules, "base_failed", "kept")
    return judged.select("doc_id", *[f"counts.{c}" for c in COUNTS], "base_failed", "kept", "counts.badness")


def keep_good(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns and no others.

    For the cutoffs only texts with a label are measured, where the labelled ids are few enough to be broadcast; else all
    are, instead of being shuffled for a join. A missing text has no words; repeated rows are judged each. The row number
    keeps the filter above the counting; pushed below it, Spark would copy the counts into the filter.
    """
    counts, number = free_name(docs, "_counts"), free_name(docs, "_number")
    failed, kept = free_name(docs, "_failed"), free_name(docs, "_kept")
    texts = docs.select("doc_id", "lang", "text")
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select("doc_id").distinct()
    if fits_broadcast(marked):
        texts = texts.join(F.broadcast(marked), "doc_id", "left_semi").select("doc_id", "lang", "text")
    for_cutoffs = materialize(measured(texts, "text", "counts").drop("text"), "quality-counts")
    cutoffs = materialize(
        certified_cutoffs(_labelled(for_cutoffs, labels, "doc_id", "lang", "counts", rules), rules), "quality-cutoffs"
    )
    numbered = measured(docs, "text", counts).withColumn(number, F.monotonically_increasing_id())
    judged = with_verdict(numbered, counts, "lang", cutoffs, rules, failed, kept)
    return judged.filter(F.col(kept) & (F.col(number) >= 0)).select(*[F.col(f"`{c}`") for c in docs.columns])
