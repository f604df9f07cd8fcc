"""Run audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.operators.rates import count_if

RUN_KEYS = ["endpoint", "query", "ingestion_date"]


class FailedRunError(RuntimeError):
    """A run fetched nothing at all."""


def run_audit(fetch_log: DataFrame) -> DataFrame:
    """One row per run from its page log.

    Messages are kept in page order; a run has a few dozen pages at most.
    """
    failed = F.coalesce("failed", F.lit(False))
    messages = F.array_sort(F.collect_list(F.when(failed, F.struct("page", "error"))))
    fetched = F.coalesce(F.sum(F.when(~failed, F.col("records"))), F.lit(0))
    audit = fetch_log.groupBy(*RUN_KEYS).agg(
        count_if(~failed).alias("pages_fetched"),
        count_if(failed).alias("pages_failed"),
        fetched.alias("records_fetched"),
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        F.transform(messages, lambda m: m["error"]).alias("error_messages"),
    )
    return audit.withColumn(
        "status",
        F.when(F.col("pages_failed") == 0, F.lit("success"))
        .when(F.col("records_fetched") > 0, F.lit("partial_failure"))
        .otherwise(F.lit("failed")),
    )


def failed_runs(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("status") == "failed")


def assert_no_failed(audit: DataFrame, shown: int = 20) -> None:
    """Raise when any run failed completely; the message names a few of them."""
    rows = failed_runs(audit).select(*RUN_KEYS).limit(shown).collect()
    if rows:
        names = ", ".join("/".join(str(v) for v in row) for row in rows)
        raise FailedRunError(f"runs failed completely, for example: {names}")


def without_failed_runs(df: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows of runs that fetched something, so a failed run never empties its partition."""
    return df.join(failed_runs(audit).select(*RUN_KEYS), RUN_KEYS, "left_anti")
