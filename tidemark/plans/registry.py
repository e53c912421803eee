"""Registered queries: name -> (builder, DuckDB oracle SQL or None).

A builder takes ``(spark, sf_dir)`` and returns a lazily planned DataFrame.
The oracle is ANSI SQL over the raw tables, prefixed with the derivations of
:mod:`tidemark.sources.tpch` so both engines see the same inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from tidemark.sources.tpch import duckdb_prelude

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, prelude: bool = True):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = (duckdb_prelude() + sql) if prelude else sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from tidemark.plans import tpch, course, joinsums, online_queries, forecasts, jobs, inventory  # noqa: F401
