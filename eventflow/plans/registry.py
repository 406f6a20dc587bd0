"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the equivalent DuckDB query over the pre-registered table views."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
