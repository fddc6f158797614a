"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own, a permutation given by a hash of its name.
The shards take turns, each claiming the next free slot of its order, until the table is full; so shards get equal parts
(or parts by weight), and a table with one shard more or less gives nearly all slots to the same shards as before. The
table has ``size`` rows whatever the data, so it is broadcast, and placing a row is one lookup.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.skew import SMALLEST_SHARE, group_hash, hot_groups

#: A prime, far above the number of shards.
SIZE = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], size: int = SIZE, weights: Mapping[str, float] | None = None) -> list[int]:
    """The number of the shard that owns each slot.

    Shards of a lower weight skip turns. The order in which the shards are given does not matter to who gets what beyond
    the numbers in the list, as turns go by name.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need different names, and one at least")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the size must be a prime not below the number of shards")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    weight = [float((weights or {}).get(name, 1.0)) for name in shards]
    if min(weight) < 0 or max(weight) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    place = [_number(name, "start") % size for name in shards]
    step = [_number(name, "step") % (size - 1) + 1 for name in shards]
    saved = [0.0] * len(shards)
    table, free = [-1] * size, size
    while free:
        for i in turns:
            saved[i] += weight[i] / max(weight)
            if saved[i] < 1 or not free:
                continue
            saved[i] -= 1
            while table[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % size
            table[place[i]] = i
            free -= 1
    return table


def table_rows(spark: SparkSession, shards: Sequence[str], table: Sequence[int]) -> DataFrame:
    """(slot, shard): a row per slot."""
    return spark.createDataFrame([(slot, shards[i]) for slot, i in enumerate(table)], "slot int, shard string")


def slot_of(size: int, *key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(size)).cast("int")


def hot_pieces(df: DataFrame, keys: Sequence[str], shards: int) -> dict[int, int]:
    """Hash of every key with more than half a shard's fair part of the rows, and how many pieces its rows make.

    A sketch finds them in one pass; they are fewer than twice the shards.
    """
    found = hot_groups(df, keys, max(SMALLEST_SHARE, 1 / (2 * shards)))
    return {key: math.ceil(2 * shards * share) for key, share in found.items()}


def placed(
    df: DataFrame,
    keys: Sequence[str],
    shards: Sequence[str],
    size: int = SIZE,
    weights: Mapping[str, float] | None = None,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """``df`` with two more columns, the slot and the shard of every row; no rows are moved.

    Rows of equal keys share a shard, but for keys that hold more than half of a shard's fair part: those are dealt over
    as many pieces as they need by a hash of the row, each piece placed by itself. So a row has the same place on every
    run. Null keys are keys like others. ``slot`` and ``shard`` must be new names; an empty table gives an empty result.
    """
    table = table_rows(df.sparkSession, shards, lookup_table(shards, size, weights))
    names = [F.col(f"`{k}`") for k in keys]
    number = slot_of(size, *names)
    by_count: dict[int, list[int]] = {}
    for key, pieces in hot_pieces(df.select(*names), keys, len(shards)).items():
        by_count.setdefault(pieces, []).append(key)
    whole_row = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])
    for pieces, found in by_count.items():
        piece = F.pmod(whole_row, F.lit(pieces))
        number = F.when(group_hash(keys).isin(found), slot_of(size, *names, piece)).otherwise(number)
    owners = table.select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    return df.withColumn(slot, number).join(F.broadcast(owners), slot)  # ``size`` rows


def write_shards(rows: DataFrame, path: str, shard: str = "shard") -> None:
    """Write placed rows, a folder per shard; every task writes its own files, so nothing is shuffled."""
    rows.write.partitionBy(shard).parquet(path)
