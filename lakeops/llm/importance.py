"""Importance resampling towards a target distribution, by hashed word runs.

Runs of one to three words fall into buckets by their CRC. How often a bucket is met in the target texts and in all
documents gives its gain, a document's weight is the sum of its runs' gains, and weights with Gumbel noise from the id are
ranked: the highest are a sample without replacement that follows the target.

Texts are worked on as Arrow columns: ``ascii_lower``, ``split_pattern_regex`` and ``list_flatten`` give the words,
``dictionary_encode`` their indices; shifted indices form the runs, only distinct runs get a CRC (put together from those
of their parts), ``take`` spreads the gains over the runs and one segment sum per document adds them up.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.batches import chunks, large_texts
from lakeops.llm.columns import free_name
from lakeops.llm.tokens import value_bytes
from lakeops.session import materialize, parallelism

BUCKETS = 10_000
#: Fixed value: what parts words, once A to Z are folded.
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Operators for texts of other lengths are worked out again when this many are kept.
KEPT_SHIFTS = 4096


@functools.lru_cache(KEPT_SHIFTS)
def _shift(length: int) -> np.ndarray:
    """What ``length`` more bytes make of a CRC, as a table for each of its four bytes.

    A CRC is linear: that of A and B together is the shifted CRC of A, exclusive-or that of B.
    """
    zeros = bytes(length)
    nothing = zlib.crc32(zeros, 0)
    bits = [zlib.crc32(zeros, 1 << bit) ^ nothing for bit in range(32)]
    table = np.zeros((4, 256), np.uint32)
    for place in range(4):
        for bit in range(8):
            step = 1 << bit
            table[place, step : 2 * step] = table[place, :step] ^ np.uint32(bits[8 * place + bit])
    return table


def _extended(crcs: np.ndarray, words: np.ndarray, word_crcs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRCs of runs with one more word: ``word_crcs`` are those of words with a blank before them, of ``sizes`` bytes."""
    kinds, of_word = np.unique(sizes, return_inverse=True)
    tables = np.stack([_shift(int(size)) for size in kinds]) if len(kinds) else np.zeros((1, 4, 256), np.uint32)
    kind = of_word[words]
    out = word_crcs[words]
    for place in range(4):
        out = out ^ tables[kind, place, (crcs >> np.uint32(8 * place)) & np.uint32(255)]
    return out


class Runs:
    """The runs of one to three words in some texts: the bucket of each distinct run, and where which one begins."""

    def __init__(self, texts: pa.Array, buckets: int):
        split = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=NOT_WORDS)
        flat = pc.list_flatten(split)
        filled = pc.greater(pc.binary_length(flat), 0)
        self.ends = np.append(0, np.cumsum(filled.to_numpy(zero_copy_only=False)))[split.offsets.to_numpy()]
        words = flat.filter(filled).dictionary_encode()
        single = words.indices.to_numpy().astype(np.int64)
        size = max(1, len(words.dictionary))
        names = words.dictionary.cast(pa.large_binary())
        crcs = np.array([zlib.crc32(word) for word in names.to_pylist()], np.uint32)
        spaced = np.array([zlib.crc32(word, zlib.crc32(b" ")) for word in names.to_pylist()], np.uint32)
        sizes = np.diff(value_bytes(names)[1]) + 1
        text_of = np.repeat(np.arange(len(texts)), np.diff(self.ends))
        # (positions at which a run of this length begins, its index among the distinct ones, their buckets)
        self.kinds = [(np.arange(len(single)), single, (crcs % buckets).astype(np.int64))]
        index, at = single, np.arange(len(single))
        for more in (1, 2):
            inside = at + more < len(single)
            inside[inside] = text_of[at[inside]] == text_of[at[inside] + more]
            at, index = at[inside], index[inside]
            pairs = pa.array(index * size + single[at + more]).dictionary_encode()
            distinct = pairs.dictionary.to_numpy()
            crcs = _extended(crcs[distinct // size], distinct % size, spaced, sizes)
            index = pairs.indices.to_numpy().astype(np.int64)
            self.kinds.append((at, index, (crcs % buckets).astype(np.int64)))

    def counts(self, buckets: int) -> np.ndarray:
        """How many runs fall into each bucket."""
        total = np.zeros(buckets, np.int64)
        for _, index, bucket in self.kinds:
            met = np.bincount(index, minlength=len(bucket))
            total += np.bincount(bucket, weights=met, minlength=buckets).astype(np.int64)
        return total

    def per_text(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, runs and the sum of the runs' gains of each text."""
        words = np.diff(self.ends)
        values = np.zeros(self.ends[-1], np.int64)
        for at, index, bucket in self.kinds:
            values[at] += gains[bucket].take(index)
        # A sum per segment; one that is empty has none.
        weights = np.zeros(len(words), np.int64)
        some = np.flatnonzero(words)
        if len(some):
            weights[some] = np.add.reduceat(values, self.ends[some])
        return words, 3 * words - np.minimum(words, 1) - np.minimum(words, 2), weights


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n`` of the runs of all texts; a task adds its own up first, and buckets without runs have no row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in chunks(batch, 0):
                total += Runs(large_texts(part.column(0)), buckets).counts(buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """A thousand times the log of how much likelier each bucket is in the target, from :func:`bucket_counts` of both."""
    both = source.select("bucket", F.col("n").alias("s")).join(target.select("bucket", F.col("n").alias("t")), "bucket", "full")
    # At most as many rows as there are buckets come here.
    rows = both.select("bucket", F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))).toArrow()
    met, s, t = (column.to_numpy() for column in rows.columns)
    all_s, all_t = np.zeros(buckets), np.zeros(buckets)
    all_s[met], all_t[met] = s, t
    ratio = (all_t + 1) * (s.sum() + float(buckets)) / ((all_s + 1) * (t.sum() + float(buckets)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight`` of every row; null texts have no words."""
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string"))
    kind = rows.schema[0].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found = Runs(large_texts(part.column(1)), len(gains)).per_text(gains)
                arrays = [part.column(0), *[pa.array(values) for values in found]]
                yield pa.RecordBatch.from_arrays(arrays, names=[key, "n_words", "n_features", "weight"])
                pa.default_memory_pool().release_unused()

    return rows.mapInArrow(weigh, f"`{key}` {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by the seed and the id; a missing id counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / float(1 << 32))))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the place of every row in a total order, from 1 on, without a task that holds all rows.

    Rows are dealt into ranges of the order and stored; each range is numbered by itself, behind the rows of the ranges
    before it. Rows that are equal in the order take any of their places.
    """
    ranges, inside = free_name(df, "_range"), free_name(df, "_inside")
    dealt = df.repartitionByRange(parallelism(df.sparkSession), *order).withColumn(ranges, F.spark_partition_id())
    stored = materialize(dealt, "numbered")
    # A row per range.
    before = Window.orderBy(ranges).rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.groupBy(ranges).agg(F.count(F.lit(1)).alias(inside))
    starts = starts.select(ranges, F.coalesce(F.sum(inside).over(before), F.lit(0)).alias(name))
    rows = stored.withColumn(inside, F.row_number().over(Window.partitionBy(ranges).orderBy(*order)))
    return rows.join(F.broadcast(starts), ranges).withColumn(name, F.col(name) + F.col(inside)).drop(ranges, inside)


def resample(
    docs: DataFrame,
    target: DataFrame,
    share_pct: int = 5,
    min_words: int = 20,
    seed: int = 42,
    buckets: int = BUCKETS,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row; ``rank`` is null for rows not drawn.

    Of the rows with at least ``min_words`` words ``share_pct`` percent are drawn, rounded down: those of the highest
    scores, ties to the smaller key, missing keys last. Null texts have no words and weight 0; repeated rows are drawn
    each; an empty target gives gains of its own smoothing; other columns are left out.
    """
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets), buckets)
    scored = weighted(docs, gains, key, text).withColumn("score", F.col("weight") + noise(F.col(f"`{key}`"), seed))
    scored = materialize(scored, "importance")
    fit = F.col("n_words") >= min_words
    drawn = scored.where(fit).count() * share_pct // 100
    order = [F.col("_fit").desc(), F.col("score").desc(), F.col(f"`{key}`").asc_nulls_last()]
    ranked = numbered(scored.withColumn("_fit", fit), order, "rank")
    # Rows that may be drawn come first.
    return ranked.select(
        F.col(f"`{key}`"), "n_features", "weight", "score", F.when(fit & (F.col("rank") <= drawn), F.col("rank")).alias("rank")
    )
