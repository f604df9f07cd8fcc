"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.functions import company, keys, location, roles
from jobweave.functions.signals import calendar_columns, days_between
from jobweave.operators.dedup import best_with_span, longest_value
from jobweave.operators.joins import override_family
from jobweave.operators.reshape import date_spine, union_tagged, with_unknown_member

# First day of the calendar and the day after its last.
CALENDAR_START, CALENDAR_END = "2020-01-01", "2030-12-31"


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return calendar(date_spine(bounds, "start", "end"))


def calendar(days: DataFrame) -> DataFrame:
    return days.select(*[col.alias(name) for name, col in calendar_columns("date_day").items()])


def dim_job_title(titles: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """One row per normalized title; a curated mapping, when given, overrides the rules."""
    dim = titles.select(
        "title_normalized",
        "title_raw_representative",
        keys.job_title_key("title_normalized").alias("job_title_key"),
        roles.role_family("title_normalized").alias("role_family"),
        roles.is_management("title_normalized").alias("is_management"),
        roles.is_technical("title_normalized").alias("is_technical"),
    )
    return dim if mapping is None else override_family(dim, mapping)


def dim_location(jobs: DataFrame, estimates: DataFrame) -> DataFrame:
    """One row per place seen by either source.

    Distinct rows, source flags and longest values are all aggregates of one
    grouping, so each source shrinks before it is shuffled.
    """
    seen = union_tagged(
        {
            "jobs": jobs.select(
                "location_key",
                F.col("city_clean").alias("city"),
                F.col("state_clean").alias("region"),
                F.col("country_clean").alias("country"),
            ),
            "salary": estimates.select("location_key", "city", "region", "country"),
        }
    )
    # A place may be spelled in several ways; the flags say whether a source has it in any of them.
    resolved = (
        seen.filter(F.col("location_key") != keys.UNKNOWN_KEY)
        .groupBy("location_key")
        .agg(
            longest_value("city").alias("city_clean"),
            longest_value("region").alias("region_clean"),
            longest_value("country").alias("country_clean"),
            F.bool_or(F.col("source") == "jobs").alias("in_job_postings"),
            F.bool_or(F.col("source") == "salary").alias("in_salary_estimates"),
        )
    )
    dim = resolved.select(
        "location_key",
        "city_clean",
        "region_clean",
        "country_clean",
        location.location_market("country_clean").alias("market"),
        location.geo_region("country_clean").alias("geo_region"),
        location.is_benchmark_market("country_clean").alias("is_benchmark_market"),
        location.tech_hub_label("city_clean").alias("tech_hub_label"),
        location.location_completeness("city_clean", "country_clean").alias("location_completeness"),
        "in_job_postings",
        "in_salary_estimates",
    )
    return with_unknown_member(
        dim,
        location_key=keys.UNKNOWN_KEY,
        market="Unknown",
        geo_region="Unknown",
        is_benchmark_market=False,
        location_completeness="unknown",
        in_job_postings=False,
        in_salary_estimates=False,
    )


def representative_company(jobs: DataFrame) -> DataFrame:
    """Most complete posting per company with counts over all its postings."""
    known = jobs.filter(F.col("company_key") != keys.UNKNOWN_KEY).select(
        "company_key",
        "company_name_clean",
        "company_website",
        "company_logo",
        "country_clean",
        "last_ingested_at",
        "job_id",
    )
    return best_with_span(
        known,
        ["company_key"],
        [
            F.col("company_website").isNull().asc(),
            F.col("company_logo").isNull().asc(),
            F.col("last_ingested_at").desc(),
            F.col("job_id").asc(),
        ],
        {
            "total_postings": F.count("*"),
            "first_seen_at": F.min("last_ingested_at"),
            "last_seen_at": F.max("last_ingested_at"),
        },
    )


def dim_company(jobs: DataFrame) -> DataFrame:
    dim = representative_company(jobs).select(
        "company_key",
        "company_name_clean",
        "company_website",
        "company_logo",
        "country_clean",
        company.company_market("country_clean").alias("hq_market"),
        company.posting_volume_band("total_postings").alias("posting_volume_band"),
        "total_postings",
        F.col("first_seen_at").cast("date").alias("first_seen_date"),
        F.col("last_seen_at").cast("date").alias("last_seen_date"),
        days_between("last_seen_at", "first_seen_at").alias("days_posting_active"),
    )
    return with_unknown_member(
        dim,
        company_key=keys.UNKNOWN_KEY,
        company_name_clean="Unknown",
        hq_market="Unknown",
        posting_volume_band="Unknown",
        total_postings=0,
        days_posting_active=0,
    )
