"""Connected components of links, without any of them on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize

#: Links that a task joins before it hands them on.
BATCH_LINKS = 1 << 18


def _contracted(links: DataFrame) -> DataFrame:
    """The same components with fewer links: each task links the nodes it meets to the smallest they hang together with."""

    def stars(parent: dict[int, int]) -> pa.RecordBatch:
        rows = [(node, _root(parent, node)) for node in parent]
        rows = [(u, v) for u, v in rows if u != v]
        columns = list(zip(*rows)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["u", "v"])

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = _root(parent, u), _root(parent, v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > BATCH_LINKS:
                yield stars(parent)
                parent = {}
        if parent:
            yield stars(parent)

    return links.mapInArrow(contract, "u long, v long")


def _root(parent: dict[int, int], node: int) -> int:
    parent.setdefault(node, node)
    while parent[node] != node:
        parent[node] = parent[parent[node]]
        node = parent[node]
    return node


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (u, v) hangs together with.

    Every round takes the smallest label among the neighbours and then the label of that label, so a chain shortens by
    half. Rounds end when no label changes; each is stored in the shared folder. Links of a hub are aggregated where they
    lie before they are shuffled.
    """
    short = _contracted(links).distinct()
    both = materialize(short.union(short.select("v", "u")), "links")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")).select(
        "node", F.least("node", "v").alias("component")
    ), "labels")
    while True:
        near = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("component").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("u"), "left").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("lower")
        )
        lower = materialize(lower, "labels")
        further = lower.select(F.col("node").alias("label"), F.col("lower").alias("further"))
        after = lower.join(further, F.col("lower") == F.col("label"), "left").select(
            "node", "before", F.least("lower", "further").alias("component")
        )
        after = materialize(after, "labels")
        labels = after.select("node", "component")
        if after.filter(F.col("before") != F.col("component")).isEmpty():
            return labels
