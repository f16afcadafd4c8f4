"""Queries over the given tables, each with an independent SQL statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mapflow.sources.tables import Tables

Run = Callable[[SparkSession, Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    run: Run
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register ``run(spark, tables)`` under a key, with its DuckDB statement."""

    def register(run: Run) -> Run:
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, run, oracle)
        return run

    return register
