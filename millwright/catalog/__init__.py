"""Registered queries over the test tables, each with its SQL where SQL can express it."""

from __future__ import annotations

import importlib

MODULES = [
    "scalar_queries", "source_queries", "medallion_queries", "analytics_queries",
    "ordered_queries", "quality_queries", "enrich_queries", "streaming_queries", "ml_queries",
]


def load():
    """(queries, SQL texts) of every catalog module."""
    from millwright.catalog import registry

    for name in MODULES:
        importlib.import_module(f"millwright.catalog.{name}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
