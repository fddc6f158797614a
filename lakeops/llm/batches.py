"""Arrow batches of texts, and what workers keep of their memory."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text that are worked on at a time; a longer text is worked on alone.
CHUNK_BYTES = 4 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def chunks(batch: pa.RecordBatch, text: int = 1, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes (else ``CHUNK_BYTES``) of text each, or one text."""
    most = most or CHUNK_BYTES
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(size):
        before = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def large_texts(column: pa.Array) -> pa.Array:
    """A column of texts, or a slice of one, as large strings whose bytes begin at the first text; null is empty.

    A cast slice keeps the bytes before it, and kernels such as ``ascii_lower`` then read the texts from a wrong place.
    """
    return pc.fill_null(pa.concat_arrays([column]).cast(pa.large_string()), "")


def give_back() -> None:
    """Return freed memory to the system; else it would stay with the worker, which Spark keeps for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


@contextmanager
def small_batches(spark: SparkSession, most: int = CHUNK_BYTES) -> Iterator[None]:
    """Jobs that run inside hand over batches of about ``most`` bytes.

    By default Spark puts up to 64 MB of texts into a batch, and executor and worker hold it several times.
    """
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, most)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)
