"""Ranks in segments of any size, without a window over the rows.

A window gives all rows of a segment to one task. Here rows are sorted into
ranges of (segment, order), so a segment with most rows spans many partitions;
a row's rank is its number in its partition's share of the segment plus what the
shares before hold. Only those shares, a row per partition and segment, meet in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.sources.tables import stage


def ranked(df: DataFrame, segment: list[str], order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with its 1-based rank (long) in the segment; without a segment, in the whole table.

    ``order`` is total. Null segments are a segment. The sorted rows are written
    to the shared folder, where their numbers stay what they are.
    """
    by = [F.col(c).asc() for c in segment] + order
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    rows = stage(ranged.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    # The number holds the partition above the row's place in it.
    placed = rows.withColumn("_share", F.shiftright("_at", 33))
    shares = placed.groupBy(*segment, "_share").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*segment).orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    shares = stage(shares, "rank-shares").select(*[F.col(c).alias(f"_s_{c}") for c in segment], F.col("_share").alias("_s_share"), "_first", "_before")
    same = F.col("_share") == F.col("_s_share")
    for c in segment:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    rank = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return placed.join(shares, same).withColumn(name, rank).select(*df.columns, name)

