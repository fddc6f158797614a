"""Registered queries, each with its SQL for the correctness check where SQL can express it."""

from __future__ import annotations

from importlib import import_module

from lakeops.queries.registry import ORACLES, QUERIES

for _module in ("analytics", "joins", "texts", "quality", "tables", "files"):
    import_module(f"lakeops.queries.{_module}")

__all__ = ["ORACLES", "QUERIES"]
