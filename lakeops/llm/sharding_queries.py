"""The registered sharding query. SQL can't fill the table; tests compare it with plain Python."""

from __future__ import annotations

from lakeops.llm.registry import query, table
from lakeops.llm.sharding import placed

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


@query("op7_maglev_shards")
def op7_maglev_shards(spark, sf_dir):
    return placed(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], SHARDS).select("doc_id", "slot", "shard")
