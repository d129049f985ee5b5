"""All registered queries; importing this module registers them."""

from __future__ import annotations

import importlib

from rainspark.plans.registry import ORACLES, QUERIES

for _name in ("ingest_queries", "table_queries", "map_queries", "stream_queries"):
    importlib.import_module(f"rainspark.plans.{_name}")

__all__ = ["ORACLES", "QUERIES"]
