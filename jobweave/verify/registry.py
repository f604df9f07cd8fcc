"""Registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Runner] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None) -> Callable[[Runner], Runner]:
    """Register a query; without SQL only its rows are checked."""
    def add(run: Runner) -> Runner:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add
