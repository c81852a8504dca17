"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
IDS: dict[str, str] = {}


def query(name: str, ids: str = "", sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; ``sql`` is the oracle text."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        IDS[name] = ids
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
