"""Change over ordered snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def snapshot_windows(
    df: DataFrame, keys: list[str], order: str, lags: dict[str, str], firsts: dict[str, str]
) -> DataFrame:
    """Previous and first values, sequence number and total, by plain windows.

    For grains that bound the group, such as one snapshot per key and day. One
    partitioning and one sort serve all of it.
    """
    ordered = Window.partitionBy(*keys).orderBy(order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns: dict[str, Column] = {new: F.lag(old).over(ordered) for new, old in lags.items()}
    columns |= {new: F.first(old).over(whole) for new, old in firsts.items()}
    columns["snapshot_number"] = F.row_number().over(ordered)
    columns["total_snapshots"] = F.count("*").over(whole)
    return df.withColumns(columns)


def sliced_windows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_by: Column,
    lags: dict[str, str],
    firsts: dict[str, str],
) -> DataFrame:
    """The same columns for keys of any size.

    Each key is cut into slices by a coarser form of its leading order column
    (a month of a date). Rows are numbered within their slice; each slice is
    reduced to its row count, its first and its last row; and those few rows
    carry the values across slice borders. A key with a third of all rows is so
    worked on by as many tasks as it has slices. ``order`` must be total and
    ``slice_by`` must not decrease along it.
    """
    cut = df.withColumn("_slice", slice_by)
    by = [*keys, "_slice"]
    # keys may hold nulls, which an equi-join would lose
    nulls = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")).alias(f"_k{i}") for i, k in enumerate(keys)]
    ids = [f"_k{i}" for i in range(len(keys))]
    inner = Window.partitionBy(*by).orderBy(*order)
    rank = F.struct(*order)
    last = {f"_last_{n}": F.max_by(F.col(old), rank) for n, old in lags.items()}
    first = {f"_first_{n}": F.min_by(F.col(old), rank) for n, old in firsts.items()}
    slices = cut.groupBy(*by).agg(
        F.count("*").alias("_rows"),
        *[c.alias(n) for n, c in (last | first).items()],
    )
    over = Window.partitionBy(*keys).orderBy("_slice")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    borders = slices.select(
        *nulls,
        F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("total_snapshots"),
        *[F.lag(f"_last_{n}").over(over).alias(f"_carry_{n}") for n in lags],
        *[F.first(f"_first_{n}").over(whole).alias(n) for n in firsts],
    )
    numbered = cut.select("*", F.row_number().over(inner).alias("_in"), *[
        F.lag(old).over(inner).alias(f"_lag_{n}") for n, old in lags.items()
    ], *nulls)
    on = [F.col("_slice") == F.col("_at"), *[numbered[i] == borders[i] for i in ids]]
    joined = numbered.join(borders, on, "inner")
    return joined.select(
        *df.columns,
        *[
            F.when(F.col("_in") == 1, F.col(f"_carry_{n}")).otherwise(F.col(f"_lag_{n}")).alias(n)
            for n in lags
        ],
        *firsts,
        (F.col("_before") + F.col("_in")).cast("int").alias("snapshot_number"),
        F.col("total_snapshots").cast("bigint").alias("total_snapshots"),
    )
