"""Queries by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def keep(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return keep
