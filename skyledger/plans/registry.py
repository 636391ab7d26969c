"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put
