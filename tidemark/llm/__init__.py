"""Operators of a training-data pipeline; nothing else in the library imports this subpackage."""

from __future__ import annotations

from importlib import import_module

MODULES = ["jaccard_join", "bpe", "substring_dedup", "embedding_dedup", "packing", "repair", "url_filter", "sharding",
           "exact_dedup", "quality", "language_id", "alignment", "conversations"]


def load() -> tuple[dict, dict]:
    """Registered queries and their oracles."""
    from tidemark.llm import registry
    for name in MODULES:
        import_module(f"tidemark.llm.{name}")
    return registry.QUERIES, registry.ORACLES
