"""All registered queries of this subpackage."""

from __future__ import annotations

from lakeops.llm import bpe_queries, chat_queries, decontaminate_queries, filter_queries, glob_queries, importance_queries, minhash_queries, quality_queries, sharding_queries, token_queries, toxicity_queries, warc_queries  # noqa: F401 - they register their queries
from lakeops.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
