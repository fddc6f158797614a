"""Benchmark decontamination: documents are scanned once by an Aho-Corasick automaton of benchmark windows.

A window is ``WINDOW`` consecutive words of a benchmark text, or a shorter text as a whole. Texts are compared as words:
ASCII capitals are folded, every ASCII character that is no letter or digit parts words. The automaton reads the words of
a document joined by single blanks; since normalising keeps the bytes of a word in place, the byte offsets of the words
lead back to the original text.

The automaton of a block of windows is broadcast as its patterns. A block is bounded by ``BLOCK_BYTES``. A benchmark with
more windows is dealt into several blocks; the documents and what one block found are stored before the next is sent, so
the driver and every worker hold one block at a time, however large the benchmark.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.batches import give_back
from lakeops.llm.columns import free_name
from lakeops.session import materialize

WINDOW = 10
#: Bytes of window texts in one automaton.
BLOCK_BYTES = 16 << 20
#: Letters and digits as they are, capitals folded, bytes of other characters as they are, all else a blank.
FOLD = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[^ ]+")


def normal_words(text: Column) -> Column:
    """The words of a text as Spark sees them; the same words as those of ``FOLD``."""
    folded = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(folded, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def benchmark_windows(
    benchmark: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW, unnamed: bool = False
) -> DataFrame:
    """(window, items): every different window with the keys of the items that hold it, as strings.

    Items without words have no window; repeated items count once. With ``unnamed``, items without a key give windows,
    too, and stand as one null behind the keys; otherwise they are left out.
    """
    words = benchmark.select(F.col(f"`{key}`").cast("string").alias("item"), normal_words(F.col(f"`{text}`")).alias("w"))
    words = words.filter((F.size("w") > 0) & (F.col("item").isNotNull() | F.lit(unnamed)))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    windows = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("words"))
    keys, missing = F.sort_array(F.collect_set("item")), F.bool_or(F.col("item").isNull())
    return windows.groupBy(F.array_join("words", " ").alias("window")).agg(
        F.when(missing, F.array_append(keys, F.lit(None).cast("string"))).otherwise(keys).alias("items")
    )


def _blocks(windows: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, list[str | None]]]]:
    """The windows in blocks of about ``block_bytes``; only one block is on the driver at a time."""
    size = windows.agg(F.sum(F.octet_length("window") + 16 * F.size("items"))).first()[0] or 0
    count = -(-size // block_bytes)
    for block in range(count):
        mine = windows.filter(F.pmod(F.xxhash64("window"), F.lit(count)) == block)
        yield [(row.window, row.items) for row in mine.collect()]


class Scanner:
    """The automaton of one block."""

    def __init__(self, patterns: list[tuple[str, list[str | None]]]):
        self.automaton = ahocorasick.Automaton()
        for window, items in patterns:
            # Bytes are handed over as Latin-1, so that ends are byte offsets.
            word = f" {window} ".encode().decode("latin-1")
            self.automaton.add_word(word, (len(word) - 2, items))
        self.empty = not patterns
        if patterns:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, int, list[tuple[int, int]], set[str | None]]:
        """How many words the text has and how many are hit, the byte spans of hit passages, and the items found.

        Spans run from the first byte of a word to behind the last byte of another; they are apart and in order.
        """
        folded = text.translate(FOLD)
        words = folded.split()
        if self.empty or not words:
            return len(words), 0, [], set()
        joined = b" " + b" ".join(words) + b" "
        found = [(end, *value) for end, value in self.automaton.iter(joined.decode("latin-1"))]
        if not found:
            return len(words), 0, [], set()
        # Places of the words in the joined and in the original text.
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1)  # in the joined text, the blank behind each word
        original = np.fromiter((m.start() for m in WORD.finditer(folded)), np.int64, len(words))
        runs: list[list[int]] = []
        for end, length, _ in found:
            last = int(np.searchsorted(ends, end))
            first = int(np.searchsorted(ends, end - length))
            while runs and runs[-1][1] >= first:
                first = min(first, runs.pop()[0])
            runs.append([first, last + 1])
        spans = [(int(original[a]), int(original[b - 1] + sizes[b - 1])) for a, b in runs]
        return len(words), sum(b - a for a, b in runs), spans, {item for *_, items in found for item in items}


_SCANNERS: dict[str, Scanner] = {}


def _worker_scanner(block: str, patterns: Broadcast) -> Scanner:
    """The automaton of a block, built once per worker; that of the block before it goes."""
    if block not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[block] = Scanner(patterns.value)
    return _SCANNERS[block]


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scanned(df: DataFrame, text: str, into: str, patterns: Broadcast) -> DataFrame:
    """``df`` with the scan of one block added to the struct column ``into``."""
    known = into in df.columns
    kind = T.StructType(
        [
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    schema = df.schema if known else T.StructType([*df.schema.fields, T.StructField(into, kind)])
    place = df.columns.index(text)
    spans_type, items_type = pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())
    arrow = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", spans_type), ("items", items_type)])

    block = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _worker_scanner(block, patterns)
        for batch in batches:
            before = batch.column(batch.schema.get_field_index(into)).to_pylist() if known else None
            out = []
            for i, value in enumerate(batch.column(place)):
                data = (value.as_py() or "").encode()
                n, hit, spans, items = scanner.scan(data)
                if before and before[i]["spans"]:
                    spans, items = _union([*map(tuple, before[i]["spans"]), *spans]), {*before[i]["items"], *items}
                    hit = sum(len(data[a:b].translate(FOLD).split()) for a, b in spans)
                items = sorted(items, key=lambda item: (item is None, item or ""))
                out.append({"n_words": n, "n_hit": hit, "spans": [list(s) for s in spans], "items": items})
            column = pa.array(out, arrow)
            others = [c for name, c in zip(batch.schema.names, batch.columns) if name != into]
            names = [name for name in batch.schema.names if name != into]
            yield pa.RecordBatch.from_arrays([*others, column], names=[*names, into])
        give_back()

    return df.mapInArrow(scan, schema)


def scanned(
    docs: DataFrame, benchmark: DataFrame, text: str, into: str, block_bytes: int = BLOCK_BYTES, unnamed: bool = False
) -> DataFrame:
    """``docs`` with a struct column: n_words, n_hit, spans (byte offsets in the text's UTF-8) and items of each whole text.

    Null and empty texts have no words, no spans and no items; an empty benchmark finds nothing. ``docs`` must not have
    columns of equal names. For ``unnamed`` see ``benchmark_windows``.
    """
    windows = materialize(benchmark_windows(benchmark, unnamed=unnamed), "benchmark-windows")
    context, sent = docs.sparkSession.sparkContext, None
    # The last column, so that a chain of blocks keeps its place.
    for block in _blocks(windows, block_bytes):
        if sent is not None:
            docs = materialize(docs, "scanned")
            sent.destroy()
        sent = context.broadcast(block)
        docs = _scanned(docs, text, into, sent)
    return docs if sent is not None else _scanned(docs, text, into, context.broadcast([]))


def contamination_report(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, unnamed: bool = False
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and spans of every row of ``docs``.

    Rows are judged one by one where they lie, so nothing is shuffled and repeated rows give repeated results.
    With ``unnamed``, items without an id make hits like others; together they count as one in n_items, and items_sha256,
    a hash of the ids, leaves them out. Otherwise they are left out of everything.
    """
    found = scanned(docs.select("doc_id", "text"), benchmark, "text", "found", block_bytes, unnamed)

    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
        "found.spans",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, unnamed: bool = False
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with all their columns.

    With ``unnamed``, windows of items without an id count, too. Rows without words stay; repeated rows are judged each;
    an empty benchmark keeps all.
    """
    into = free_name(docs, "_found")
    found = scanned(docs, benchmark, "text", into, block_bytes, unnamed)
    return found.filter(F.size(f"{into}.spans") == 0).drop(into)
