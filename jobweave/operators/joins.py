"""Joins of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.functions import roles
from jobweave.functions.keys import UNKNOWN_KEY, UNKNOWN_TITLE_KEY
from jobweave.operators.dedup import best_per_key


def spread_unknown(df: DataFrame, key: str, unknown: str | int, spread_by: str) -> Column:
    """Join key whose unknown and null values are spread over many hashes.

    Unknown members can be a third of a fact. They never need a match, so each
    gets a value no dimension holds instead of meeting in one shuffle partition.
    """
    value, salt = F.col(key), F.col(spread_by)
    if isinstance(unknown, int):
        # hashed titles are never negative
        other = F.lit(-2).cast("bigint") - F.pmod(F.xxhash64(salt), F.lit(1 << 20))
    else:
        # md5 keys never start with a tilde
        other = F.concat(F.lit("~"), F.coalesce(salt.cast("string"), F.lit("")))
    return F.when(value.isNull() | (value == unknown), other).otherwise(value)


def validate_foreign_key(
    fact: DataFrame, dim: DataFrame, key: str, unknown: str | int, spread_by: str
) -> DataFrame:
    """Keep keys the dimension knows; point the others at the unknown member."""
    # Hashed keys can collide; a key that two members share must not multiply facts.
    known = dim.select(F.col(key).alias("_known")).filter(F.col("_known") != F.lit(unknown)).distinct()
    probe = fact.withColumn("_probe", spread_unknown(fact, key, unknown, spread_by))
    joined = probe.join(known, F.col("_probe") == F.col("_known"), "left")
    fallback = F.lit(unknown).cast(fact.schema[key].dataType)
    return joined.withColumn(key, F.coalesce(F.col("_known"), fallback)).drop("_known", "_probe")


def scoped_titles(dim_title: DataFrame) -> DataFrame:
    """Titles a mart may show: known and in scope, one per key.

    Two titles can share a hashed key; the first by name stands for both, so no fact is counted twice.
    """
    shown = dim_title.filter(
        (F.col("job_title_key") != UNKNOWN_TITLE_KEY) & ~F.col("role_family").isin(roles.EXCLUDED_FAMILIES)
    )
    return best_per_key(shown, ["job_title_key"], [F.col("title_normalized").asc_nulls_last()])


def benchmark_locations(dim_location: DataFrame) -> DataFrame:
    return dim_location.filter(F.col("is_benchmark_market"))


def combine_measures(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two aggregates on their shared keys.

    With the dimensions joined afterwards this yields every (title, location)
    pair that has data, without pairing all titles with all locations first.
    """
    return left.join(right, keys, "full_outer")


def max_per_company(df: DataFrame, company: str, rank: str, name: str) -> DataFrame:
    """Attach each company's highest rank.

    A grouped maximum joined back; the correlated form and the whole-partition
    window both pull a large company into one task.
    """
    top = df.groupBy(company).agg(F.max(rank).alias(name))
    return df.join(top, company, "left")


def not_in(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys do not occur in ``seen``."""
    return df.join(seen.select(*keys).distinct(), keys, "left_anti")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of rows behind each."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("orphan_key")).agg(
        F.count("*").alias("child_rows")
    )
    known = parent.select(F.col(parent_key).alias("orphan_key")).distinct()
    return keys.join(known, "orphan_key", "left_anti")


def override_family(titles: DataFrame, mapping: DataFrame) -> DataFrame:
    """Curated mapping wins over the rules; matched on the lower-cased title.

    The mapping is a hand-kept file, so its size is left to Spark to check.
    """
    curated = (
        mapping.withColumn("_title", F.lower(F.trim("title_normalized")))
        .groupBy("_title")
        .agg(
            F.min("role_family").alias("_family"),
            F.bool_or("is_technical").alias("_technical"),
            F.bool_or("is_management").alias("_management"),
        )
    )
    joined = titles.join(curated, F.lower(titles["title_normalized"]) == F.col("_title"), "left")
    return joined.withColumns(
        {
            "role_family": F.coalesce("_family", "role_family"),
            "is_technical": F.coalesce("_technical", "is_technical"),
            "is_management": F.coalesce("_management", "is_management"),
        }
    ).drop("_title", "_family", "_technical", "_management")


def with_calendar(df: DataFrame, dim_date: DataFrame, columns: list[str], key: str = "date_key") -> DataFrame:
    """Inner join on the day key; the calendar has one row per day, so it is small by nature."""
    return df.join(dim_date.select(key, *columns), key)
