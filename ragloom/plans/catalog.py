"""Registry of named queries: each is a Spark plan over the driver tables
plus (where SQL can express it) its DuckDB twin.

`QUERIES[name](spark, sf_dir) -> DataFrame` and `ORACLE[name] -> str`.
Every query reads whole tables; no id subsets, samples or row caps (limits
appear only where they are the operator, e.g. top-k or `head(10)`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOTES: dict[str, str] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    """Decorator: register a Spark query under `name` with optional oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        if note:
            NOTES[name] = note
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from ragloom.plans import (  # noqa: F401
        q_dense, q_rag, q_sessions, q_sources, q_streaming, q_structured, q_tools, q_vectors,
    )
