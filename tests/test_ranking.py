"""Ranks without a window over the rows, also where one segment holds most of them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from jobweave.operators import ranking
from jobweave.operators.ranking import ranked
from jobweave.sources.tables import stage


def test_rank_equals_window_and_spreads_a_large_segment(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(ranking, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 == 0, F.concat(F.lit("s"), F.col("id") % 7)).alias("seg"),
        F.xxhash64("id").alias("v"),
        "id",
    )
    order = [F.col("v").desc(), F.col("id").asc()]
    got = ranked(df, ["seg"], order, "rank", partitions=16)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("seg").orderBy(*order)).cast("long"))
    assert got.exceptAll(want).isEmpty() and got.count() == 20_000
    # No partition of the sorted rows has much more than its share.
    sizes = sorted(r["count"] for r in staged[0].groupBy(F.shiftright("_at", 33)).count().collect())
    assert len(sizes) >= 12 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_rank_of_nothing_and_of_one_segment(spark):
    df = spark.range(0).select(F.lit("a").alias("seg"), "id")
    assert ranked(df, ["seg"], [F.col("id").asc()], "rank").count() == 0
    whole = ranked(spark.range(1_000), [], [F.col("id").desc()], "rank", partitions=5).collect()
    assert all(r.rank == 1_000 - r.id for r in whole)
