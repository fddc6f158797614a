"""Near-duplicates by min-max hashing.

A document is the set of its five-word shingles. Under each of ``PERMUTATIONS`` permutations both the smallest and the
largest hash are kept, so a signature has twice as many values as hashes were worked out. ``BANDS`` bands of ``ROWS``
values go to buckets; documents that share a bucket are candidates, and every link is confirmed on the full sets.

Not all pairs of a bucket are written out:
 * Documents with equal sets are one class, and only one of a class takes part.
 * First every class is compared with the smallest of each of its buckets. Links join classes to components.
 * Buckets that lie in one component are done. In the others, classes of different components are compared by their
   signatures, in blocks of a bounded size, those of the bucket's largest component only with the rest. First each class
   goes on with its most similar partner. After that has joined components, the classes still in open buckets get
   ``FINE`` more permutations, and all pairs still apart go on whose signatures agree in ``AGREE`` of the values and whose
   finer ones in ``AGREE_FINE`` at least, each in the first bucket that it shares.
No pair of a bucket is left out but by its sizes, by being in one component already, or by that agreement, which a linked
pair misses with a chance of about 1 in five million (5.1 standard deviations of 500 values at a similarity of 0.75, and
5.2 of the 2500).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.batches import give_back
from lakeops.llm.columns import free_name
from lakeops.llm.components import components
from lakeops.session import materialize, parallelism

SHINGLE = 5
PERCENT = 75
PERMUTATIONS = 250
ROWS = 5
#: Bands of the minima and maxima of the first permutations; the others make the estimate of similarity finer.
BANDS = 40
AGREE = 0.65
#: More permutations for classes that buckets still keep apart, and the agreement that all values together need there.
FINE = 1000
AGREE_FINE = 0.705
#: Classes that are compared at a time.
BLOCK = 256
#: Ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Words whose hashes a worker keeps.
KEPT_WORDS = 150_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_MASKS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_FINE_FACTORS = _random.integers(0, 1 << 63, FINE, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_FINE_MASKS = _random.integers(0, 1 << 63, FINE, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_BAND_SEEDS = _random.integers(0, 1 << 63, BANDS, dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: dict[bytes, int]) -> np.ndarray:
    """The different shingles of a text as ascending hashes; one of all words if there are fewer than five."""
    found = (text or "").encode(errors="replace").lower().split()  # ASCII only: as bytes
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(SHINGLE, len(hashes))
    out = np.full(len(hashes) - width + 1, np.uint64(width))
    for i in range(width):
        out = _mixed(out * _MIX + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minima and maxima under all permutations, 16 bits of each; those that are banded stand first."""
    low, high = _ends(hashes, _MASKS, _FACTORS)
    first = BANDS * ROWS // 2
    return np.concatenate([low[:first], high[:first], low[first:], high[first:]]).astype("<u2")


def fine_signature(hashes: np.ndarray) -> np.ndarray:
    """The minima and maxima under ``FINE`` other permutations, 8 bits of each."""
    return np.concatenate(_ends(hashes, _FINE_MASKS, _FINE_FACTORS)).astype("u1")


def _ends(hashes: np.ndarray, masks: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.full(len(masks), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(masks), np.uint64)
    for i in range(0, len(hashes), 512):
        x = (hashes[None, i : i + 512] ^ masks) * factors
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return low, high


def band_keys(values: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band."""
    out = _BAND_SEEDS.copy()
    for column in values[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        out = _mixed(out * _MIX + column.astype(np.uint64))
    return out.view(np.int64)


def _as_long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row, key, text_hash, n_shingles, set_a and set_b (a hash of the set), signature and bands of every row."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").cast("long").alias("key"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        F.col(f"`{text}`").alias("text"),
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            sizes, first, second, signatures, bands = [], [], [], [], []
            for value in batch.column(3):
                hashes = shingles(value.as_py(), words)
                whole = xxhash.xxh3_128_intdigest(hashes.tobytes())
                values = signature(hashes)
                sizes.append(len(hashes))
                first.append(_as_long(whole >> 64))
                second.append(_as_long(whole & ((1 << 64) - 1)))
                signatures.append(values.tobytes())
                bands.append(band_keys(values))
            flat = pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64))
            offsets = pa.array(np.arange(len(bands) + 1, dtype=np.int32) * BANDS)
            columns = [pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())]
            columns += [pa.array(signatures, pa.binary()), pa.ListArray.from_arrays(offsets, flat)]
            names = ["row", "key", "text_hash", "n_shingles", "set_a", "set_b", "signature", "bands"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=names)
        words.clear()
        give_back()

    schema = "row long, key long, text_hash long, n_shingles long, set_a long, set_b long, signature binary, bands array<long>"
    return rows.mapInArrow(sign, schema)


def _small(ids: DataFrame) -> DataFrame:
    """``ids`` marked for a broadcast if there are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _sets(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted (node, key, text_hash), worked out again from their texts."""
    texts = docs.select(
        F.col(f"`{key}`").cast("long").alias("its_key"),
        F.xxhash64(F.col(f"`{text}`")).alias("its_hash"),
        F.col(f"`{text}`").alias("text"),
    )
    same = F.col("its_key").eqNullSafe(F.col("key")) & (F.col("its_hash") == F.col("text_hash"))
    found = texts.join(_small(wanted), same).select("node", "text")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            sets = [shingles(value.as_py(), words).view(np.int64) for value in batch.column(1)]
            offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            flat = pa.array(np.concatenate([np.zeros(0, np.int64), *sets]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["node", "shingles"]
            )
        words.clear()
        give_back()

    # Rows that are repeated, key and text, give the same set more than once.
    return found.mapInArrow(shingled, "node long, shingles array<long>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar enough on their full sets."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv")).cast("long")
    joined = pairs.join(right, "v").join(left, "u")
    return joined.filter(100 * both >= PERCENT * (F.size("su") + F.size("sv") - both)).select("u", "v")


def _near_sizes(a, b):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) after the components that ``links`` (u, v) connect were joined."""
    u, v = labels.toDF("u", "cu"), labels.toDF("v", "cv")
    between = links.join(u, "u").join(v, "v").filter("cu != cv").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    merged = components(materialize(between.distinct(), "component-links")).toDF("old", "new")
    after = labels.join(merged, F.col("component") == F.col("old"), "left")
    return materialize(after.select("node", F.coalesce("new", "component").alias("component")), "node-components")


def _fine(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, fine) of some nodes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            signed = [fine_signature(lists[i].values.to_numpy().view(np.uint64)).tobytes() for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed, pa.binary())], names=["node", "fine"])

    return sets.join(nodes, "node", "left_semi").select("node", "shingles").mapInArrow(sign, "node long, fine binary")


def _compared(
    members: DataFrame, labels: DataFrame, signatures: DataFrame, best_only: bool, sets: DataFrame
) -> DataFrame:
    """Pairs (u, v) of classes in one bucket but different components whose signatures agree.

    ``members`` has bucket, band, node and size. ``best_only``: of each class only the most similar partner in a block;
    else all pairs, by finer signatures made of ``sets``.
    """
    placed = materialize(members.join(labels, "node"), "placed")
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    open_buckets = parts.groupBy("bucket").agg(
        F.max_by("component", "n").alias("main"), F.max("n").alias("n_main"), (F.sum("n") - F.max("n")).alias("n_rest")
    )
    open_buckets = materialize(open_buckets.filter("n_rest > 0"), "open-buckets")
    rows = placed.join(open_buckets, "bucket")
    is_main = F.col("component") == F.col("main")
    one_block = F.col("n_main") + F.col("n_rest") <= BLOCK
    n_rest = F.when(one_block, 1).otherwise(F.ceil(F.col("n_rest") / BLOCK)).cast("int")
    n_main = F.when(one_block, 0).otherwise(F.ceil(F.col("n_main") / BLOCK)).cast("int")
    rows = rows.withColumns({"is_main": is_main & ~one_block, "blocks": n_rest, "more": n_main})
    spread = F.xxhash64("node")
    block = F.when(F.col("is_main"), F.col("blocks") + F.pmod(spread, F.greatest("more", F.lit(1)))).otherwise(
        F.pmod(spread, F.col("blocks"))
    )
    rows = rows.withColumn("block", block.cast("int"))
    # Blocks of the rest meet all blocks, those of the main component only blocks of the rest.
    others = F.when(F.col("is_main"), F.col("blocks")).otherwise(F.col("blocks") + F.col("more"))
    dealt = rows.select(
        "bucket",
        "band",
        "node",
        "size",
        "component",
        "block",
        F.explode(F.sequence(F.lit(0), others - 1)).alias("other"),
    ).select(
        "bucket",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        "block",
        "band",
        "node",
        "size",
        "component",
    )
    dealt = materialize(dealt, "blocks")
    if best_only:
        dealt = dealt.join(signatures.withColumn("fine", F.lit(b"")), "node")
    else:
        fine = materialize(_fine(sets, dealt.select("node").distinct()), "fine-signatures")
        dealt = dealt.join(signatures.join(fine, "node"), "node")
    dealt = dealt.repartition(parallelism(members.sparkSession), "bucket", "one", "two")
    ordered = dealt.sortWithinPartitions("bucket", "one", "two", "node").select(
        "bucket", "one", "two", "block", "band", "node", "size", "component", "signature", "fine"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            pairs = _similar(group, best_only)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    return ordered.mapInArrow(compare, "u long, v long").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of equal (bucket, one, two), which are neighbours; a group is bounded by two blocks."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        keys = np.stack([table.column(i).to_numpy() for i in range(3)])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(table)]
        for a, b in zip(cuts, cuts[1:-1]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-2])
    if rest is not None and len(rest):
        yield rest


def _similar(group: pa.Table, best_only: bool) -> np.ndarray:
    """The pairs of a group that are to be confirmed."""
    if len(group) < 2:
        return np.zeros((0, 2), np.int64)
    one, two = group.column("one")[0].as_py(), group.column("two")[0].as_py()
    block, node, size, component = (group.column(c).to_numpy() for c in ("block", "node", "size", "component"))
    data = np.frombuffer(b"".join(group.column("signature").to_pylist()), "<u2").reshape(len(group), -1)
    fine = np.frombuffer(b"".join(group.column("fine").to_pylist()), "u1").reshape(len(group), -1)
    band = group.column("band")[0].as_py()
    left = np.flatnonzero(block == one)
    right = left if one == two else np.flatnonzero(block == two)
    out = []
    # A few rows of the left block at a time bound the memory.
    for i in range(0, len(left), 64):
        mine = left[i : i + 64]
        low, high = np.minimum.outer(size[mine], size[right]), np.maximum.outer(size[mine], size[right])
        valid = (100 * low >= PERCENT * high) & (component[mine][:, None] != component[right][None, :])
        if one == two:
            valid &= mine[:, None] < right[None, :]
        a, b = np.nonzero(valid)
        if not len(a):
            continue
        for j in range(0, len(a), 8192):
            x, y = mine[a[j : j + 8192]], right[b[j : j + 8192]]
            equal = data[x] == data[y]
            shared = equal[:, : BANDS * ROWS].reshape(len(x), BANDS, ROWS).all(axis=2)
            agree = equal.mean(axis=1)
            keep = (agree >= AGREE) & (best_only | (shared.argmax(axis=1) == band))
            if not best_only:
                some = np.flatnonzero(keep)
                finer = (fine[x[some]] == fine[y[some]]).sum(axis=1) + equal[some].sum(axis=1)
                keep[some] = finer >= AGREE_FINE * (fine.shape[1] + equal.shape[1])
            out.append(np.column_stack([x[keep], y[keep], (agree[keep] * 1e6).astype(np.int64)]))
    pairs = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    if best_only and len(pairs):
        ends = np.concatenate([pairs[:, [0, 1, 2]], pairs[:, [1, 0, 2]]])
        ends = ends[np.lexsort((ends[:, 1], -ends[:, 2], ends[:, 0]))]
        first = np.concatenate([[True], ends[1:, 0] != ends[:-1, 0]])
        pairs = ends[first]
    u, v = node[pairs[:, 0]], node[pairs[:, 1]]
    return np.column_stack([np.minimum(u, v), np.maximum(u, v)])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row, key, text_hash, n_shingles and component (a row of the group, the same for all its rows) of every row.

    Null and empty texts and texts of white space have no shingles and hang together with nothing. Repeated rows have
    equal sets and so one component. Keys may be null or repeated; rows are told apart by a number of their own, which
    is stored with them once.
    """
    rows = materialize(signed(docs, key, text), "signatures")
    full = rows.filter("n_shingles > 0")
    classes = full.groupBy("set_a", "set_b").agg(F.min("row").alias("node"), F.count("*").alias("n"))
    classes = materialize(classes.filter("n > 1").drop("n"), "classes")
    with_node = full.join(classes, ["set_a", "set_b"], "left").withColumn("node", F.coalesce("node", "row"))
    members = materialize(with_node.select("row", "key", "text_hash", "n_shingles", "node"), "class-members")
    nodes = materialize(
        with_node.filter(F.col("node") == F.col("row")).select(
            "node", "key", "text_hash", F.col("n_shingles").alias("size"), "signature", "bands"
        ),
        "nodes",
    )
    banded = nodes.select("node", "size", F.posexplode("bands").alias("band", "bucket"))
    buckets = banded.groupBy("bucket").agg(
        F.min(F.struct("node", "size")).alias("low"), F.max("node").alias("high")
    )
    buckets = materialize(
        buckets.filter("low.node != high").select("bucket", F.col("low.node").alias("low"), F.col("low.size").alias("low_size")),
        "buckets",
    )
    candidates = materialize(banded.join(buckets, "bucket"), "candidates")
    involved = materialize(candidates.select("node").distinct(), "involved")
    wanted = materialize(nodes.select("node", "key", "text_hash").join(involved, "node"), "wanted")
    sets = materialize(_sets(docs, key, text, wanted), "shingle-sets")
    stars = candidates.filter((F.col("low") != F.col("node")) & _near_sizes(F.col("size"), F.col("low_size")))
    stars = materialize(stars.select(F.col("low").alias("u"), F.col("node").alias("v")).distinct(), "star-pairs")
    start = involved.select("node", F.col("node").alias("component"))
    labels = _joined(start, materialize(_confirmed(stars, sets), "star-links"))
    signatures = materialize(nodes.select("node", "signature").join(involved, "node"), "involved-signatures")
    in_buckets = candidates.select("bucket", "band", "node", "size")
    for best_only in (True, False):
        pairs = materialize(_compared(in_buckets, labels, signatures, best_only, sets), "pairs")
        labels = _joined(labels, materialize(_confirmed(pairs, sets), "links"))
    moved = labels.filter("node != component")
    linked = members.join(moved, "node", "left").select(
        "row", "key", "text_hash", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    alone = rows.filter("n_shingles = 0").select("row", "key", "text_hash", "n_shingles", F.col("row").alias("component"))
    return materialize(linked.union(alone), "near-duplicates")


def duplicate_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id of the group) and kept of every row of ``docs``.

    A group of null ids only has a null component_id, and its rows are not kept. Rows that repeat the smallest id are
    all kept, as the rule goes by the id.
    """
    found = near_duplicates(docs)
    groups = found.groupBy("component").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    groups = materialize(groups.filter("n > 1").drop("n"), "groups").withColumnRenamed("component", "its_component")
    named = found.join(groups, F.col("component") == F.col("its_component"), "left").withColumn(
        "component_id", F.when(F.col("its_component").isNull(), F.col("key")).otherwise(F.col("least"))
    )
    kept = F.coalesce(F.col("key") == F.col("component_id"), F.lit(False))
    return named.select(F.col("key").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every group of near-duplicates: that of the smallest doc_id (nulls last), with all its columns.

    Rows without words are in no group and stay. The rows that go are told by id and text; where such a pair is there
    more than once, one of the equal rows stays.
    """
    found = near_duplicates(docs)
    order = F.struct(F.col("key").isNull(), "key", "text_hash", "row")
    groups = found.groupBy("component").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    groups = materialize(groups.filter("n > 1").select("component", F.col("first.row").alias("first")), "groups")
    judged = found.join(groups, "component", "left").withColumn(
        "stays", F.col("first").isNull() | (F.col("first") == F.col("row"))
    )
    pairs = judged.groupBy("key", "text_hash").agg(
        F.max("stays").alias("stays"), F.count_if(~F.col("stays")).alias("go"), F.count("*").alias("n")
    )
    pairs = materialize(pairs.filter("go > 0"), "row-verdicts")
    key, hashed = free_name(docs, "_key"), free_name(docs, "_hash")
    named = [F.col("key").alias(key), F.col("text_hash").alias(hashed)]
    go = _small(pairs.filter(~F.col("stays")).select(*named))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(F.col("text")) == F.col(hashed))
    left = docs.join(go, same, "left_anti")
    repeated = pairs.filter(F.col("stays") & (F.col("n") > 1)).select(*named)
    if repeated.isEmpty():
        return left
    repeated = _small(repeated)
    once = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, same, "left_anti").unionByName(once)
