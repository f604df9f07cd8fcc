"""Stored relations: tables, views and pruned reads."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from jobweave.session import scratch_path

# The columns a benchmark reader asks for.
BENCHMARK_COLUMNS = [
    "title_normalized",
    "role_family",
    "market",
    "country_clean",
    "is_management",
    "is_technical",
    "total_postings",
    "postings_with_salary",
    "salary_disclosure_rate_pct",
    "salary_currency",
    "salary_median_annual",
    "salary_min_annual",
    "salary_max_annual",
    "base_salary_median_annual",
    "additional_pay_pct",
    "salary_bucket",
    "base_salary_bucket",
    "estimate_reliability",
    "estimate_sample_size",
    "salary_source",
]


# Texts take about half the disk that they take with the default, for little more time.
CODEC = "zstd"


# Removes a job's shuffle files when it ends: what is written is read from its own files.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_files(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = (), codec: str = CODEC) -> None:
    """Write Parquet files; the shuffles behind them are freed at once."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).option("compression", codec).partitionBy(*partition_by).parquet(path)
    finally:
        conf.set(_CLEANUP, before) if before is not None else conf.unset(_CLEANUP)


def materialize_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a full-refresh table and hand back a scan of it."""
    write_files(df, path, "overwrite", partition_by or ())
    return df.sparkSession.read.parquet(path)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage at a model boundary with a table in the shared scratch folder."""
    path = scratch_path(df.sparkSession, label)
    write_files(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(*staged: DataFrame) -> None:
    """Delete stage tables after their last reader, so that the shared folder holds only what is still needed."""
    for df in staged:
        sc = df.sparkSession.sparkContext
        for folder in {os.path.dirname(file) for file in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def read_mart(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return spark.read.parquet(path).select(*(columns or BENCHMARK_COLUMNS))
