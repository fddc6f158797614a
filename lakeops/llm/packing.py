"""Best-fit packing of token ids into sequences of a fixed size.

Each task packs its own rows, so no text is shuffled: pieces go to the open bin with the least room that still takes
them. Open bins are kept by their free space, and a bitset with a bit per free space finds the bin in constant time. At
most ``OPEN_BINS`` bins are open; where one more is needed, the fullest closes. Pieces wait in a small window and enter
the longest first, so that short ones fill what long ones leave.

What a task leaves with room is packed anew: the pieces of all sequences that are filled to less than ``FULL_PERCENT`` go
to a few groups over all tasks, so that many tasks need hardly more sequences than one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.batches import chunks, small_batches
from lakeops.llm.columns import free_name
from lakeops.llm.tokens import piece_ids
from lakeops.session import materialize

SIZE = 2048
OPEN_BINS = 4096
#: Sequences that are filled less are packed again with those of other tasks.
FULL_PERCENT = 99
#: Pieces that are packed again in one task, about.
GROUP_PIECES = 500_000
#: Tokens that wait at a time, and pieces: of short texts few tokens are many rows.
WAITING = 8 << 20
WAITING_PIECES = 100_000
#: Bytes of text that are encoded at a time; a longer text is encoded alone.
CHUNK_BYTES = 2 << 20


#: Marks the numbers of sequences that were packed again.
AGAIN = 1 << 62


class BestFit:
    """Bounded-space online best-fit; bins are numbered as they open."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.limit = size, open_bins
        self.bits = 0  # bit f: there is an open bin with f free
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = 0
        self.bins = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for a piece of 1 to ``size`` tokens."""
        roomy = self.bits >> length
        if roomy:
            free = length + (roomy & -roomy).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.size, self.bins
            self.bins += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.size - free


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of about ``CHUNK_BYTES``; null texts are empty. Only one chunk's texts are Python's at a time."""
    for batch in batches:
        for chunk in chunks(batch, most=CHUNK_BYTES):
            yield chunk.column(0), [t or "" for t in chunk.column(1).to_pylist()]


def _packed_by_task(
    docs: DataFrame,
    tokenizer: str,
    key: str,
    text: str,
    size: int,
    end_id: int,
    open_bins: int,
    with_ids: bool,
) -> DataFrame:
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string"))
    kind = rows.schema[0].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
        + (", ids binary" if with_ids else "")
    )
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins = piece_ids(tokenizer), BestFit(size, open_bins)
        base = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        tokens = 0

        def placed() -> pa.RecordBatch:
            # The sort is stable: equal lengths keep the order of the rows.
            waiting.sort(key=lambda row: -row[3])
            out = []
            for one, piece, start, length, crc, ids in waiting:
                number, offset = bins.place(length)
                out.append((one, piece, start, length, crc, base + number, offset, ids))
            columns = list(zip(*out))[: 8 if with_ids else 7]
            names = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"][: len(columns)]
            types = [key_type, pa.int32(), *[pa.int64()] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        key_type = None
        for keys, texts in _chunks(batches):
            key_type = keys.type
            for one, ids in zip(keys.to_pylist(), encoder.encode(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    row = (one, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)
                    waiting.append(row)
                tokens += len(ids) // 4
            if tokens >= WAITING or len(waiting) >= WAITING_PIECES:
                yield placed()
                waiting, tokens = [], 0
        if waiting:
            yield placed()

    return rows.mapInArrow(pack, schema)


def packed(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    end_id: int = 0,
    open_bins: int = OPEN_BINS,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: key, piece, start, length, ids_crc32, sequence_id, offset (and the packed ids).

    A document is the ids of its whole text and the end id; null and empty texts are the end id alone. Only documents
    longer than ``size`` are cut. Repeated rows are packed each, null keys stay null, an empty table gives no rows.
    ``tokenizer`` is a path that every executor has.
    """
    first = _packed_by_task(docs, tokenizer, key, text, size, end_id, open_bins, with_ids)
    names = [F.col(f"`{name}`") for name in first.columns]
    filled = free_name(first, "_filled")
    of_sequence = F.sum("length").over(Window.partitionBy("sequence_id"))
    with small_batches(docs.sparkSession):
        pieces = materialize(first, "pieces")
    rows = materialize(pieces.withColumn(filled, of_sequence), "filled-pieces")
    roomy = F.col(filled) * 100 < FULL_PERCENT * size
    again = rows.where(roomy)
    groups = -(-again.count() // GROUP_PIECES)
    if groups == 0:
        return rows.select(*names)
    group = free_name(first, "_group")
    dealt = again.select(*names, F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).cast("int").alias(group))
    repacked = dealt.groupBy(group).applyInArrow(_repacker(group, size, open_bins), first.schema)
    return rows.where(~roomy).select(*names).unionByName(repacked)


def _repacker(group: str, size: int, open_bins: int):
    """Packs the pieces of a group, the longest first, into sequences with numbers that no task gives."""

    def repack(table: pa.Table) -> pa.Table:
        number = table.column(group)[0].as_py()
        # Equal lengths by what else is known of them, so that a task that is run again packs alike.
        order = [("length", "descending"), ("ids_crc32", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")]
        table = table.drop_columns([group]).sort_by(order)
        bins = BestFit(size, open_bins)
        places = [bins.place(length) for length in table.column("length").to_pylist()]
        base = AGAIN | number << 40
        for name, values in (("sequence_id", [base + n for n, _ in places]), ("offset", [at for _, at in places])):
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(values, pa.int64()))
        return table

    return repack
