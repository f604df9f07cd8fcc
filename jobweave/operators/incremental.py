"""Watermarks and upserts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.operators.dedup import latest_per_key
from jobweave.session import scratch_path


def watermark(target: DataFrame, column: str) -> Column | None:
    """Greatest value of the target as a literal, None when it is empty.

    Times travel as text or microseconds, so neither the session's nor the
    driver's time zone can shift them.
    """
    kind = target.schema[column].dataType
    newest = F.max(column)
    if isinstance(kind, T.TimestampType):
        bound = target.agg(F.unix_micros(newest)).first()[0]
        return None if bound is None else F.timestamp_micros(F.lit(bound))
    if isinstance(kind, T.TimestampNTZType):
        newest = newest.cast("string")
    bound = target.agg(newest).first()[0]
    return None if bound is None else F.lit(bound).cast(kind)


def since_watermark(source: DataFrame, target: DataFrame, column: str, inclusive: bool = False) -> DataFrame:
    """Source rows newer than anything in the target; all of them for an empty target.

    The bound is fetched once and compared as a literal, so it reaches the scan.
    """
    bound = watermark(target, column)
    if bound is None:
        return source
    return source.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the rest is kept.

    Null keys match each other. ``source`` has one row per key.
    """
    fresh = source.select(*keys).alias("fresh")
    kept = target.join(fresh, _same_keys(target, fresh, keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def upsert_keeping_span(
    target: DataFrame, source: DataFrame, keys: list[str], first: str, last: str
) -> DataFrame:
    """Upsert that widens the seen span instead of resetting it to the batch's."""
    old = target.select(
        *[F.col(k).alias(f"_old_{k}") for k in keys],
        F.col(first).alias("_old_first"),
        F.col(last).alias("_old_last"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])
    merged = source.join(old, same, "left").withColumns(
        {first: F.least(first, "_old_first"), last: F.greatest(last, "_old_last")}
    )
    return upsert(target, merged.select(*target.columns), keys)


def upsert_newest(newest_first: list[str]) -> Callable[[DataFrame, DataFrame, list[str]], DataFrame]:
    """Merge rule that never lets an older row replace a newer one.

    A replayed or late batch then leaves the table as it was.
    """
    def merge(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
        return latest_per_key(target.unionByName(source.select(*target.columns)), keys, *newest_first)

    return merge


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition: str,
    merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = upsert,
) -> None:
    """Upsert into a parquet table, rewriting only the partitions the source touches.

    ``partition`` is part of the key or a function of it, so no key moves
    between partitions. The merge is written to the shared scratch folder
    first: the table is then replaced from finished files, and the plan that
    reads it is not the one that overwrites it.
    """
    # One value per partition folder, not per row.
    touched = [row[0] for row in source.select(partition).distinct().collect()]
    if not touched:
        return
    target = read_or_empty(spark, path, source.schema)
    there = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:
        # The null folder is replaced like any other, so its rows take part in the merge too.
        there = F.col(partition).isNull() | F.coalesce(there, F.lit(False))
    merged = merge(target.filter(there), source, keys)
    staged = scratch_path(spark, "merge")
    merged.write.parquet(staged)
    (
        spark.read.schema(merged.schema)
        .parquet(staged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
