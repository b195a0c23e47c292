"""All registered queries of the library and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with DuckDB SQL for the same rows where there is any."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register


from millrace.plans import (  # noqa: E402, F401
    aggregates,
    changes,
    cleaning,
    enrichment,
    estimation,
    matching,
    routing,
    scans,
    streams,
    texts,
    windows,
)
