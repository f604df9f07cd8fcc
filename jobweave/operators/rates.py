"""Counts, rates and ranks in segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Part as a percentage of whole; null for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def disclosure(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Postings, postings with pay, and their share per group."""
    shown = count_if(F.col(flag))
    return df.groupBy(*keys).agg(
        F.count("*").alias("total_postings"),
        shown.alias("postings_with_salary"),
        rate_pct(shown, F.count("*")).alias("salary_disclosure_rate_pct"),
    )


def rank_in_segment(df: DataFrame, segment: list[str], order: list[Column], name: str) -> DataFrame:
    """1-based rank in the segment; the input is an aggregate, so segments are small."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*segment).orderBy(*order)))


def index_to_average(df: DataFrame, value: str, group: list[str], name: str) -> DataFrame:
    """Value relative to the group's average; the input is an aggregate."""
    mean = F.avg(value).over(Window.partitionBy(*group))
    return df.withColumn(name, F.round(F.col(value) / F.nullif(mean, F.lit(0.0)), 2))


def options(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
