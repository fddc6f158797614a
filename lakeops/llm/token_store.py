"""Token ids in shard files with a minimal perfect hash index.

Documents are sorted by key over range partitions. A shard is three files: the raw ids (little-endian unsigned, 16 bits
where the vocabulary allows, else 32; one document after another), an index, and a list of its keys, which only a scan of
the whole shard reads. The index maps a key to a slot of its own by levels of bits: a key sits on the first level where no
other key shares its bit, and its slot is the number of bits set before it. A slot holds a fingerprint, which tells unknown
keys, and the first row of the key and how many rows it has; offsets of rows lead to the ids. Keys themselves are not in the
index. A look-up reads the few pages of the index that it needs, so it costs the same in a shard of any size. A manifest,
one row per shard, gives files, first and last key and sizes.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.llm.packing import _chunks
from lakeops.llm.storage import created, new_file, range_reader
from lakeops.llm.tokens import piece_ids
from lakeops.session import materialize, parallelism, work_dir

#: Bits per key on a level.
GAMMA = 2.0
LEVELS = 64
#: Bytes of ids read at a time.
READ_BYTES = 8 << 20
#: Bytes of an index that are read at once, and how many such pages a shard keeps.
PAGE = 1 << 16
KEPT_PAGES = 256
#: Arrays of an index begin at multiples of this many bytes.
ALIGNED = 64
MANIFEST = (
    "ids_file string, index_file string, keys_file string, first_key long, last_key long, place long, n_docs long, n_tokens long, "
    "null_docs long"
)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """A minimal perfect hash of different 64-bit keys: each gets its own number below their count.

    ``words`` holds the bits of all levels, a level beginning with a word of its own, and ``before`` how many bits are set
    before each word. Both may be arrays, or stored ones with a ``take``.
    """

    def __init__(self, words, before, sizes: list[int]):
        self.words, self.before, self.sizes = words, before, sizes
        self.starts = np.concatenate([[0], np.cumsum([-(-size // 64) for size in sizes])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        words, sizes = [np.zeros(0, "<u8")], []
        for level in range(LEVELS):
            if not len(keys):
                break
            size = max(64, int(len(keys) * GAMMA))
            places = _mixed(keys, level) % np.uint64(size)
            alone = np.bincount(places.astype(np.int64), minlength=size) == 1
            bits = np.zeros(-(-size // 64) * 64, bool)
            bits[:size] = alone
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            keys = keys[~alone[places.astype(np.int64)]]
        if len(keys):
            raise ValueError("keys are not different")
        together = np.concatenate(words)
        counts = np.bitwise_count(together).astype("<u8")
        return cls(together, np.cumsum(counts) - counts, sizes)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of unknown keys some slot, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            places = _mixed(keys[left], level) % np.uint64(size)
            word, bit = (places >> np.uint64(6)).astype(np.int64) + self.starts[level], places & np.uint64(63)
            held = self.words.take(word)
            here = (held >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(held[here] & ((np.uint64(1) << bit[here]) - np.uint64(1)))
            out[left[here]] = self.before.take(word[here]).astype(np.int64) + below
            left = left[~here]
        return out


def write_index(keys: np.ndarray, lengths: np.ndarray, null_docs: int, width: int) -> bytes:
    """The index of a shard: ``lengths`` of all rows in order, ``keys`` (ascending) of those behind the null keys."""
    different, first, run = np.unique(keys, return_index=True, return_counts=True)
    hashed = PerfectHash.build(different.view(np.uint64))
    slots = hashed.slots(different.view(np.uint64))
    slot = np.zeros(len(different), SLOT)
    slot["print"][slots], slot["row"][slots], slot["rows"][slots] = fingerprints(different.view(np.uint64)), first + null_docs, run
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    arrays = {"words": hashed.words, "before": hashed.before, "slots": slot, "offsets": offsets}
    head, at = {}, 0
    for name, values in arrays.items():
        head[name] = (at, len(values))
        at += -(-values.nbytes // ALIGNED) * ALIGNED
    text = json.dumps({"sizes": hashed.sizes, "null_docs": null_docs, "width": width, "arrays": head}).encode()
    out = len(text).to_bytes(8, "little") + text + bytes(-(8 + len(text)) % ALIGNED)
    return out + b"".join(values.tobytes() + bytes(-values.nbytes % ALIGNED) for values in arrays.values())


#: What a slot holds: the fingerprint of its key, the key's first row and how many rows it has.
SLOT = np.dtype([("print", "<u4"), ("rows", "<u4"), ("row", "<u8")])
KINDS = {"words": np.dtype("<u8"), "before": np.dtype("<u8"), "slots": SLOT, "offsets": np.dtype("<u8")}


class Stored:
    """An array in a file, of which only the pages that are asked for are read."""

    def __init__(self, file, start: int, count: int, kind: np.dtype):
        self.file, self.start, self.count, self.kind = file, start, count, kind
        self.pages: dict[int, np.ndarray] = {}
        self.reads = 0

    def take(self, places: np.ndarray) -> np.ndarray:
        per_page = PAGE // self.kind.itemsize
        out = np.zeros(len(places), self.kind)
        pages = places // per_page
        for page in np.unique(pages).tolist():
            mine = pages == page
            out[mine] = self._page(page, per_page)[places[mine] - page * per_page]
        return out

    def _page(self, page: int, per_page: int) -> np.ndarray:
        if page not in self.pages:
            if len(self.pages) >= KEPT_PAGES:
                self.pages.clear()
            first = page * per_page
            size = min(per_page, self.count - first) * self.kind.itemsize
            self.pages[page] = np.frombuffer(self.file.read_at(size, self.start + first * self.kind.itemsize), self.kind)
            self.reads += 1
        return self.pages[page]


class Shard:
    """Keyed access to the ids of one shard."""

    def __init__(self, ids_file: str, index_file: str):
        index = range_reader(index_file)
        length = int.from_bytes(index.read_at(8, 0), "little")
        head = json.loads(index.read_at(length, 8))
        start = -(-(8 + length) // ALIGNED) * ALIGNED
        self.arrays = {name: Stored(index, start + at, count, KINDS[name]) for name, (at, count) in head["arrays"].items()}
        self.slots, self.offsets = self.arrays["slots"], self.arrays["offsets"]
        self.null_docs, self.kind = head["null_docs"], np.dtype(f"<u{head['width']}")
        self.hashed = PerfectHash(self.arrays["words"], self.arrays["before"], head["sizes"])
        self.file = range_reader(ids_file)

    def rows_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first row of each key and how many it has; none for keys that the fingerprints tell apart from all here."""
        hashes = np.ascontiguousarray(keys, np.int64).view(np.uint64)
        slots = self.hashed.slots(hashes)
        rows, counts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        some = np.flatnonzero(slots >= 0)
        held = self.slots.take(slots[some])
        known = held["print"] == fingerprints(hashes[some])
        rows[some[known]], counts[some[known]] = held["row"][known], held["rows"][known]
        return rows, counts

    def documents(self, key: int | None) -> list[np.ndarray]:
        """The ids of every document with the key."""
        if key is None:
            first, count = 0, self.null_docs
        else:
            first, count = (int(found[0]) for found in self.rows_of(np.array([key])))
        return [self.row(row) for row in range(first, first + count)]

    def spans(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of rows begin and end."""
        return self.offsets.take(rows).astype(np.int64), self.offsets.take(rows + 1).astype(np.int64)

    def row(self, row: int) -> np.ndarray:
        start, end = self.spans(np.array([row]))
        return self.ids(int(start[0]), int(end[0]))

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids between two offsets."""
        width = self.kind.itemsize
        return np.frombuffer(self.file.read_at(width * (end - start), width * start), self.kind).astype("<u4")


def write_store(
    docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int = 2
) -> DataFrame:
    """Write the shards of ``docs`` and return their manifest, which is stored beside them.

    Null texts are empty, so their ids are the end id alone. Null keys stand first; repeated keys are neighbours, ordered
    by text. A shard that a lost task left behind is in no manifest.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    order = [F.col("k").asc_nulls_first(), F.xxhash64("t")]
    shards = rows.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, keys, lengths, ids_file = piece_ids(tokenizer), [], [], new_file(folder, ".ids")
        width = 2 if max(end_id, len(encoder.ends) - 1) < 1 << 16 else 4
        end, stream = end_id.to_bytes(width, "little"), None
        for some, texts in _chunks(batches):
            stream = stream or created(ids_file)
            for ids in encoder.encode(texts):
                stream.write(np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes() + end)
                lengths.append(len(ids) // 4 + 1)
            keys.append(some)
        if stream is None:
            return
        stream.close()
        column = pa.chunked_array(keys)
        known = column.drop_null().to_numpy()
        nulls = column.null_count
        index_file, keys_file = (ids_file.removesuffix(".ids") + ending for ending in (".idx", ".keys"))
        with created(index_file) as out:
            out.write(write_index(known, np.array(lengths, np.int64), nulls, width))
        with created(keys_file) as out:
            out.write(known.astype("<i8").tobytes())
        row = [ids_file, index_file, keys_file, *((int(known[0]), int(known[-1])) if len(known) else (None, None))]
        row += [TaskContext.get().partitionId(), len(lengths), sum(lengths), nulls]
        types = [*[pa.string()] * 3, *[pa.int64()] * 6]
        names = [field.split()[0] for field in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    written = shards.mapInArrow(write, MANIFEST)
    written.write.parquet(f"{folder}/manifest")
    return spark.read.schema(written.schema).parquet(f"{folder}/manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids in all shards before; one row per shard, so one task holds them."""
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_store(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, looked up key by key in the files.

    Rows of a repeated key follow each other, null keys stand first; an empty manifest gives no rows.
    """
    spark = manifest.sparkSession
    listed = materialize(with_starts(manifest).select("ids_file", "index_file", "keys_file", "start"), "token-shards")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids_file, index_file, keys_file, start in zip(*[c.to_pylist() for c in batch.columns]):
                with range_reader(keys_file) as file:
                    keys = np.frombuffer(file.read_at(file.size(), 0), "<i8")
                yield from _shard_rows(Shard(ids_file, index_file), keys, start)

    dealt = listed.repartition(parallelism(spark))
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _shard_rows(shard: Shard, all_keys: np.ndarray, base: int) -> Iterator[pa.RecordBatch]:
    nulls = shard.null_docs
    different, run = np.unique(all_keys, return_counts=True)
    heads, counts = shard.rows_of(different)
    if not np.array_equal(run, counts):
        raise ValueError("the index does not hold the shard's keys")
    # Rows of a key follow its first row, which the hash gives.
    inside = np.arange(len(all_keys)) - np.repeat(np.cumsum(run) - run, run)
    rows = np.concatenate([np.arange(nulls), np.repeat(heads, run) + inside]).astype(np.int64)
    starts, ends = shard.spans(rows)
    at = 0
    while at < len(rows):
        # Neighbouring documents are read together.
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + READ_BYTES // 4)))
        data = memoryview(shard.ids(int(starts[at]), int(ends[stop - 1])).tobytes())
        cuts = zip(((starts[at:stop] - starts[at]) * 4).tolist(), ((ends[at:stop] - starts[at]) * 4).tolist())
        crcs = [zlib.crc32(data[a:b]) for a, b in cuts]
        keys = [all_keys[i - nulls].item() if i >= nulls else None for i in range(at, stop)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()),
                pa.array(starts[at:stop] + base),
                pa.array(ends[at:stop] - starts[at:stop]),
                pa.array(crcs, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )
        at = stop


def routed(wanted: DataFrame, manifest: DataFrame) -> DataFrame:
    """``key`` and the files of every shard that may hold it, for distinct ``key``s; keys between shards have no row.

    Keys and first keys of shards are dealt into ranges together and stored. In a range a key belongs to the last shard
    that begins at or before it, or to the last one of the ranges before. Shards that end with a key hold it, too, so a
    key whose rows fill many shards is found in all of them.
    """
    tasks = parallelism(wanted.sparkSession)
    shards = manifest.filter(F.col("first_key").isNotNull()).select("ids_file", "index_file", "first_key", "last_key", "place")
    shard = F.struct("place", "ids_file", "index_file", "last_key")
    both = wanted.select("key", F.lit(None).cast(shards.select(shard.alias("s")).schema["s"].dataType).alias("shard")).union(
        shards.select(F.col("first_key").alias("key"), shard)
    )
    dealt = both.repartitionByRange(tasks, "key").withColumn("range", F.spark_partition_id())
    stored = materialize(dealt, "routed-keys")
    # A row per range.
    edges = stored.groupBy("range").agg(F.max("shard").alias("last"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select("range", F.max("last").over(before).alias("before"))
    # Of equal keys all shards stand before; places rise with first keys, so the greatest is the last.
    inside = Window.partitionBy("range").orderBy("key")
    placed = stored.withColumn("latest", F.max("shard").over(inside)).filter(F.col("shard").isNull())
    placed = placed.join(F.broadcast(edges), "range").withColumn("latest", F.coalesce("latest", "before"))
    held = placed.filter(F.col("key") <= F.col("latest.last_key"))
    begun = held.select("key", "latest.place", "latest.ids_file", "latest.index_file")
    ending = wanted.join(shards.withColumnRenamed("last_key", "key"), "key").select("key", "place", "ids_file", "index_file")
    return begun.union(ending).distinct().drop("place")


def fetch(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``ids`` (packed) of every document whose key is among ``keys``; unknown and null keys have no row.

    Keys are dealt by shard and hash, so the keys of one shard may go to several tasks; each reads only the pages of the
    index that its keys need. Keys that are asked for twice count once; repeated documents have a row each.
    """
    spark = manifest.sparkSession
    wanted = keys.select(F.col(f"`{key}`").cast("long").alias("key")).filter(F.col("key").isNotNull()).distinct()
    pieces = F.pmod(F.xxhash64("key"), F.lit(8))
    dealt = routed(wanted, manifest).select("ids_file", "index_file", "key").repartition(parallelism(spark), "ids_file", pieces)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = {}
        for batch in batches:
            found, ids = [], []
            for ids_file, index_file, one in zip(*[c.to_pylist() for c in batch.columns]):
                if ids_file not in shards:
                    shards = {ids_file: Shard(ids_file, index_file)}
                for document in shards[ids_file].documents(one):
                    found.append(one)
                    ids.append(document.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(ids, pa.binary())], names=[key, "ids"])

    return dealt.sortWithinPartitions("ids_file").mapInArrow(read, f"`{key}` long, ids binary")


def new_store_folder(spark) -> str:
    return work_dir(spark, "tokens")
