"""Name -> query and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.inputs import oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, body: str | None = None, *inputs: str) -> Callable[[Query], Query]:
    """Register a query; ``body`` is its oracle over the named inputs."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if body is not None:
            ORACLES[name] = oracle(body, *inputs)
        return fn

    return register
