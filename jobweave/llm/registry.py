"""Queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Runner] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query; without SQL its tests hold it against a brute-force version."""

    def add(run: Runner) -> Runner:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
